"""Column -> Column helpers (JVM-side expressions unless stated)."""

from textloom.functions.text import *  # noqa: F401,F403
from textloom.functions.arrays import *  # noqa: F401,F403
