"""The corpus pipeline: quality, language, near duplicates, mixing and packing of documents, one stage after the other."""

from postalis.llm.stages import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
