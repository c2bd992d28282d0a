"""moodstream — sentiment stream analytics as Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` (or a Structured
Streaming query built from the same functions), so the same code runs on a
batch table and on a live stream.
"""

from moodstream.schemas import LABELS  # noqa: F401

__version__ = "0.1.0"
