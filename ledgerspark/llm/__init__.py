"""Training-data operators: each module holds one operator; see README, part "Training-data pipeline"."""
