"""tokenloom: Spark-native speech-corpus and token-sequence operators.

Every operator is a function ``DataFrame -> DataFrame`` or ``Column -> Column``
built from Spark SQL expressions, joins, windows and higher-order functions, so
Catalyst plans, prunes and distributes the work. Python workers are used only
for trained tokenisers, audio decoding and user-supplied models.
"""

from tokenloom.layout import STAGE1, STAGE2, TokenLayout  # noqa: F401
from tokenloom.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["STAGE1", "STAGE2", "TokenLayout", "get_spark", "checkpoint_dir"]
