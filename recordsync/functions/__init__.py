from .text import *  # noqa: F401,F403
from .nested import *  # noqa: F401,F403
