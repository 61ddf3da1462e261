"""spark-submit entry point of the streaming job (see adtally.app)."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from adtally.app import main  # noqa: E402

if __name__ == "__main__":
    main()
