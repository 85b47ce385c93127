"""Imports every module that registers queries."""
from vecflow.plans import ordering  # noqa: F401
from vecflow.plans import decoding  # noqa: F401
from vecflow.plans import changes  # noqa: F401
