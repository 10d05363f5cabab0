"""tracewright: cleaning and analysis of agent conversation logs on Spark."""

from importlib import import_module

__version__ = "0.2.0"

#: Public names and where they are; imported when first asked for.
_PUBLIC = {
    "read": "sources.delivery",
    "text_lines": "sources.delivery",
    "clean": "plans.clean",
    "write": "plans.clean",
    "build": "plans.report",
    "markdown": "plans.report",
    "merge_traces": "plans.merge",
    "merge_reports": "plans.merge",
    "judge_files": "plans.platforms",
    "evaluate": "operators.rules",
    "normalize": "operators.normalize",
    "unwrap": "operators.response",
    "identify": "operators.session",
}
__all__ = sorted(_PUBLIC)


def __getattr__(name: str):
    if name not in _PUBLIC:
        raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
    return getattr(import_module(f".{_PUBLIC[name]}", __name__), name)
