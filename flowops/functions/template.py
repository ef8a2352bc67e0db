"""``${name}`` templates compiled to Column expressions.

Only name substitution and ``${literal("text")}`` are understood.
A missing or null name gives the empty string.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .maps import let

_MARK = re.compile(r"\$\{([^}]*)\}")
_LITERAL = re.compile(r"""^\s*literal\(\s*(?:"([^"]*)"|'([^']*)')\s*\)\s*$""")


def _name(mark: str) -> str:
    mark = mark.strip()
    if len(mark) > 1 and mark[0] == mark[-1] and mark[0] in "'\"":
        return mark[1:-1]
    return mark


def quoted(name: str) -> str:
    """A column name as an identifier, dots and all."""
    return "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class Template:
    """Alternating constant text and names."""

    parts: tuple[tuple[str, str], ...]  # ("text" | "name", value)

    @classmethod
    def parse(cls, text: str) -> Template:
        parts: list[tuple[str, str]] = []
        end = 0
        for mark in _MARK.finditer(text):
            parts.append(("text", text[end:mark.start()]))
            constant = _LITERAL.match(mark.group(1))
            if constant:
                parts.append(("text", constant.group(1) or constant.group(2) or ""))
            else:
                parts.append(("name", _name(mark.group(1))))
            end = mark.end()
        parts.append(("text", text[end:]))
        return cls(tuple(p for p in parts if p[0] == "name" or p[1]))

    @property
    def names(self) -> list[str]:
        return [value for kind, value in self.parts if kind == "name"]

    def constant(self) -> str | None:
        """The text, where no row can change it."""
        return None if self.names else "".join(value for _, value in self.parts)

    def render(self, lookup: Callable[[str], Column | None]) -> Column:
        """Expression for the filled-in text."""
        cells = []
        for kind, value in self.parts:
            if kind == "text":
                cells.append(F.lit(value))
            else:
                found = lookup(value)
                cells.append(F.lit("") if found is None else F.coalesce(found.cast("string"), F.lit("")))
        if not cells:
            return F.lit("")
        return cells[0] if len(cells) == 1 else F.concat(*cells)


def template(text: str, columns: Iterable[str]) -> Column:
    """Compile ``text`` against the given column names."""
    known = set(columns)
    return Template.parse(text).render(lambda name: F.col(quoted(name)) if name in known else None)


def template_text(text: Column, values: Column) -> Column:
    """Fill in a template that is a column itself, from a map of names to texts; null stays null.

    The text between the marks and the marks come from one pattern each, so a value that looks
    like a mark is not filled in again.
    """
    mark = r"\$\{([^}]*)\}"
    constant = r"""^\s*literal\(\s*(?:"([^"]*)"|'([^']*)')\s*\)\s*$"""

    def fill(name: Column) -> Column:
        bare = F.trim(name)
        unquoted = F.when(bare.rlike(r"""^(?s)(?:"[^"]*"|'[^']*')$"""), F.substring(bare, F.lit(2), F.length(bare) - 2)).otherwise(bare)
        fixed = F.concat(F.regexp_extract(name, constant, 1), F.regexp_extract(name, constant, 2))
        return F.when(name.rlike(constant), fixed).otherwise(F.coalesce(F.element_at(values, unquoted), F.lit("")))

    parts = F.split(text, mark, -1)
    marks = F.regexp_extract_all(text, F.lit(mark), F.lit(1))
    filled = F.zip_with(parts, marks, lambda part, name: F.concat(part, F.when(name.isNotNull(), fill(name)).otherwise(F.lit(""))))
    return F.when(text.contains("${"), F.array_join(filled, "")).otherwise(text)


def expand_again(text: Column, columns: Mapping[str, Column], passes: int) -> tuple[Column, Callable[[Column], Column]]:
    """Re-expand already expanded text until nothing is left, at most ``passes`` times.

    Returns the text and a test of it that is true where names are still left (a cycle).
    """
    known = "|".join(re.escape(name) for name in sorted(columns, key=len, reverse=True)) or "(?!)"
    unknown = r"\$\{(?!(?:" + known + r")\})[^}]*\}"
    marks = F.array(
        *[F.struct(F.lit("${" + n + "}").alias("mark"), F.coalesce(v.cast("string"), F.lit("")).alias("value")) for n, v in columns.items()]
    )

    def fill(held: Column) -> Column:
        return F.aggregate(marks, F.regexp_replace(held, unknown, ""), lambda acc, m: F.replace(acc, m["mark"], m["value"]))

    def settle(held: Column) -> Column:
        # folds, not unrolled calls: the plan stays small however many columns there are
        return F.aggregate(F.sequence(F.lit(1), F.lit(passes)), held, lambda acc, _: F.when(acc.contains("${"), fill(acc)).otherwise(acc))

    settled = let(text, lambda held: F.when(held.contains("${"), settle(held)).otherwise(held)) if columns else text
    return settled, lambda done: done.rlike(r"\$\{(?:" + known + r")\}")
