"""Column-level functions: code chapters, keyword classes, time arithmetic."""

from stayflow.functions import codes, keywords, timefn  # noqa: F401
