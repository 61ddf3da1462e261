"""spark-submit entry point of the batch (backfill) job (see adtally.batch)."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from adtally.batch import main  # noqa: E402

if __name__ == "__main__":
    main()
