"""``python -m coevo align|couple``."""

import sys

from .plans.project import main

sys.exit(main())
