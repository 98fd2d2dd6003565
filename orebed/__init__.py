"""orebed: table-in/table-out data-mining operators on Spark DataFrames."""

from orebed.config import MiningConfig

__all__ = ["MiningConfig"]
