"""Shardweave: enrichment of sharded multimodal datasets, expressed as Spark DataFrames."""

from shardweave.session import checkpointed, scratch_path, ship_package

__all__ = ["checkpointed", "scratch_path", "ship_package"]
