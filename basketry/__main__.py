import sys

from basketry.cli import main

sys.exit(main())
