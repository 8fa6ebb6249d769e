"""Where the test tables lie."""

import os
from pathlib import Path

TESTDATA = Path(os.environ.get("TESTDATA_DIR", "/root/testdata"))
