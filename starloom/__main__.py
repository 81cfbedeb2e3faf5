"""``python -m starloom all --raw data/raw --root /shared/mart``."""

import sys

from starloom.jobs.load import main

sys.exit(main())
