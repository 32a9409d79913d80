"""Routing of text by ordered rules, and of lines by families of patterns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.functions import patterns as P
from docloom.functions import text as T


def first_match(c, rules: list[tuple[str, str]], default: str) -> Column:
    """The name of the first rule whose pattern is found."""
    c, out = T.col(c), None
    for name, pattern in rules:
        out = F.when(c.rlike(pattern), name) if out is None else out.when(c.rlike(pattern), name)
    return F.lit(default) if out is None else out.otherwise(default)


def lines_by_family(c, families: dict[str, str], plain: tuple[str, str], default: str) -> dict[str, Column]:
    """Lines that match each family's pattern, distinct, joined; a line may be in several. Lines of no family
    go to ``plain[0]`` if they match ``plain[1]``, else to ``default``."""
    lines = F.filter(F.transform(F.split(T.col(c), "\n"), T.strip), lambda x: x != "")

    def none(x: Column) -> Column:
        out = F.lit(True)
        for p in families.values():
            out = out & ~x.rlike(p)
        return out

    def chosen(name: str, pattern: str):
        def hit(x: Column) -> Column:
            out = x.rlike(pattern)
            if name == plain[0]:
                out = out | (none(x) & x.rlike(plain[1]))
            if name == default:
                out = out | (none(x) & ~x.rlike(plain[1]))
            return out

        return hit

    return {name: F.array_join(F.array_distinct(F.filter(lines, chosen(name, pattern))), "\n") for name, pattern in families.items()}


def split_duration(c) -> dict[str, Column]:
    """The three kinds of period that one cell mixes."""
    families = {"visa_validity": P.VALIDITY, "single_stay": P.SINGLE_STAY, "total_stay": P.TOTAL_STAY}
    return lines_by_family(c, families, ("single_stay", P.PLAIN_PERIOD), "total_stay")


def route_table(c) -> Column:
    return first_match(c, P.TABLE_ROUTES, P.TABLE_DEFAULT)
