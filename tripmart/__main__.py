import sys

from tripmart.cli import main

sys.exit(main())
