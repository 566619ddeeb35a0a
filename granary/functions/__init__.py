"""Column helpers. Everything here is a JVM-side expression; no Python UDFs."""

from granary.functions import dates, json_paths, moments, numeric, text

__all__ = ["dates", "json_paths", "moments", "numeric", "text"]
