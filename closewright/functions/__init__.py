"""Column expressions: text, numbers, dates and business labels."""

from closewright.functions.dates import *  # noqa: F401,F403
from closewright.functions.labels import *  # noqa: F401,F403
from closewright.functions.text import *  # noqa: F401,F403
