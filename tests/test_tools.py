import json

import zstandard

from tools.stage_times import stages


def _events():
    done = lambda sid, name, n, start, end: {
        "Event": "SparkListenerStageCompleted",
        "Stage Info": {"Stage ID": sid, "Stage Name": f"{name} at x.py:1", "Number of Tasks": n,
                       "Submission Time": start, "Completion Time": end},
    }
    return [{"Event": "SparkListenerApplicationStart"}, done(1, "parquet", 8, 100, 600), done(2, "collect", 1, 0, 50)]


def test_stage_times_reads_plain_and_zstd_logs(tmp_path):
    text = "\n".join(json.dumps(e) for e in _events()) + "\n"
    plain = tmp_path / "plain" / "events_1_app"
    plain.parent.mkdir()
    plain.write_text(text)
    packed = tmp_path / "packed" / "events_1_app.zstd"
    packed.parent.mkdir()
    packed.write_bytes(zstandard.ZstdCompressor().compress(text.encode()))
    for folder in (plain.parent, packed.parent):
        got = sorted((r["stage"], r["name"], r["tasks"], r["ms"]) for r in stages(str(folder)))
        assert got == [(1, "parquet", 8, 500), (2, "collect", 1, 50)]
