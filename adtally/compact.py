"""Batch job beside the streaming job: compact the log of the display totals.

    python -m adtally.compact --table <output>/display_metrics

Run it on a schedule; readers and the stream go on meanwhile.
"""

from __future__ import annotations

import argparse

from .config import get_session
from .streaming.queries import compact_display


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--table", required=True)
    print(compact_display(get_session(), p.parse_args(argv).table.rstrip("/")))


if __name__ == "__main__":
    main()
