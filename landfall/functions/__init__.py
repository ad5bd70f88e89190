from landfall.functions.columns import *  # noqa: F401,F403
from landfall.functions.dates import *  # noqa: F401,F403
