from learnmetrics.functions.columns import *  # noqa: F401,F403
from learnmetrics.functions.columns import __all__ as _all  # noqa: F401
