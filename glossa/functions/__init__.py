"""Column -> Column scalar functions and predicates."""

from glossa.functions.scalars import *  # noqa: F401,F403
