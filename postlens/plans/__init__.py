from .incremental import add_batch, batches, market_so_far, merged_tally
from .market import MarketRun, record_market
from .training import TrainingRun, train

__all__ = ["MarketRun", "TrainingRun", "add_batch", "batches", "market_so_far", "merged_tally", "record_market", "train"]
