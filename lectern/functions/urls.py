"""URL expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def path_to_uri(path: Column, domain: str, scheme: str = "https://") -> Column:
    """``scheme + domain +`` whatever follows the last ``domain`` in the path."""
    return F.concat(F.lit(scheme + domain), F.substring_index(path, domain, -1))


def strip_anchor(source: Column) -> Column:
    """The page: everything before the first ``#``."""
    return F.substring_index(source, "#", 1)


def anchor_of(source: Column) -> Column:
    """What follows the first ``#``; NULL without one."""
    return F.when(
        F.instr(source, "#") > 0,
        F.substring(source, F.instr(source, "#") + 1, F.length(source)),
    )


def url_tag(url: Column, prefix: str) -> Column:
    """First path component after ``prefix`` (plain text), anchor removed; NULL if absent."""
    component = F.regexp_extract(url, re.escape(prefix) + "([^/]+)", 1)
    return F.substring_index(F.nullif(component, F.lit("")), "#", 1)


def url_last_segment(url: Column) -> Column:
    """Last path component."""
    return F.substring_index(url, "/", -1)


def classifier_text(url: Column, question: Column) -> Column:
    """Classifier input: last path component and the question."""
    return F.concat_ws(" ", url_last_segment(url), question)
