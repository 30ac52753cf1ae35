"""Run the batch chain end to end (same as ``python -m ledgerspark``).

usage:
  python scripts/run_chain.py --csv <raw csv path> --out <folder> [--serve <folder>] [--train]
  python scripts/run_chain.py --events <sf dir> --out <folder> [--serve <folder>] [--train]
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerspark.cli import main  # noqa: E402

if __name__ == "__main__":
    raise SystemExit(main())
