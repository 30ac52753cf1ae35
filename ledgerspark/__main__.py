"""``python -m ledgerspark``: run the batch chain (see ``ledgerspark.cli``)."""

from .cli import main

raise SystemExit(main())
