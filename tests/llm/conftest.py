"""The folder is a package, so that its modules may be named like those beside it; ``corpora`` is not."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
