from .columns import *  # noqa: F401,F403
