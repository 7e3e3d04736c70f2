import sys

from tabsmith.cli import main

sys.exit(main())
