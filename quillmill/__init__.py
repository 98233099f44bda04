"""quillmill: raw text sources to one corpus shape, as Spark DataFrame plans.

Every source ends up as two tables: a corpus (``id``, ``text``) and a metadata
table with one record per corpus line.
"""

from quillmill.session import get_session

__all__ = ["get_session"]
