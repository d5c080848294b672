"""Incremental (streaming) loads."""

from .incremental import incremental_load, obs_decoder

__all__ = ["incremental_load", "obs_decoder"]
