"""SQL counterparts of the registered queries, written independently of the Spark plans."""

from lakevault.oracles.statements import ORACLES

__all__ = ["ORACLES"]
