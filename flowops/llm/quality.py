"""Quality rules: a threshold table compiled into one projection of built-in functions.

Words are runs of anything but ASCII white space, over the whole text. Frequent words are looked for as
listed, with a capital, and in capitals, and only where at most a quarter as many bytes are added by
characters outside ASCII as there are characters: texts in other scripts have none of them, and other
rules decide. Of languages in Latin letters those of ``STOP_WORDS`` are covered. Null text counts as empty:
all counts are 0, and the document is rejected by the word count. An empty table gives an empty
result; each repeated row has its own. The columns are expressions over the text column alone, so
other columns, whatever their names, do not matter. Work in a row grows as n log n with its words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed by the contract of the counts.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
REPEAT_WORDS = 3

#: Frequent words of languages in Latin letters: English, German, French, Spanish, Italian, Portuguese,
#: Dutch, Swedish, Danish and Norwegian, Finnish, Polish, Turkish, Indonesian.
STOP_WORDS = [
    *["the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "on", "with", "as", "be", "by", "this", "are"],
    *["der", "die", "das", "und", "den", "von", "zu", "mit", "ist", "nicht", "ein", "eine", "dem", "des"],
    *["le", "la", "les", "de", "et", "un", "une", "du", "que", "qui", "dans", "en", "est", "pour"],
    *["el", "los", "las", "y", "del", "se", "por", "con", "para", "una", "no", "su"],
    *["il", "di", "che", "non", "per", "gli", "sono", "della"],
    *["o", "os", "do", "da", "em", "um", "uma", "com"],
    *["het", "een", "van", "op", "te", "dat", "zijn", "niet"],
    *["och", "att", "det", "som", "av", "med", "har", "till", "inte", "om"],
    *["og", "til", "ikke", "er", "fra", "jeg", "af"],
    *["ja", "ei", "oli", "joka", "mutta", "ovat"],
    *["i", "w", "na", "nie", "z", "jest", "od"],
    *["ve", "bir", "bu", "ile", "daha", "olarak"],
    *["yang", "dan", "ini", "itu", "untuk", "dengan"],
]


@dataclass(frozen=True)
class Rule:
    """A ratio of two counts must lie between two bounds; a missing bound does not bind."""

    name: str
    count: str
    of: str
    least: float | None = None
    most: float | None = None


#: Counts are those of :func:`quality_counts`. A ratio over nothing passes.
RULES = [
    Rule("mean_word_length", "word_chars", "n_words", 2.0, 14.0),
    Rule("symbol_ratio", "n_symbols", "n_words", None, 0.4),
    Rule("stop_word_ratio", "n_stop_words", "n_latin_words", 0.01, None),
    Rule("duplicate_line_ratio", "n_dup_lines", "n_lines", None, 0.5),
    Rule("ellipsis_line_ratio", "n_ellipsis_lines", "n_lines", None, 0.5),
]


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once however often it is used."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(words: Column, width: int = REPEAT_WORDS) -> Column:
    """Words inside ``width``-word windows that occur twice or more, the first time included."""

    def of(w: Column) -> Column:
        hashes = F.transform(F.slice(w, 1, F.size(w) - (width - 1)), lambda x, i: F.xxhash64(x, *[F.get(w, i + j) for j in range(1, width)]))

        def positions(s: Column) -> Column:
            twice = F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]))
            return F.sort_array(F.transform(twice, lambda x: x["i"]))

        def covered(p: Column) -> Column:
            own = F.transform(p, lambda x, k: F.least(F.lit(width), F.coalesce(F.get(p, k + 1) - x, F.lit(width))))
            return F.aggregate(own, F.lit(0).cast("long"), lambda total, x: total + x)

        def counted(h: Column) -> Column:
            placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
            return F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(_let(placed, lambda s: _let(positions(s), covered)))

        none = F.lit(0).cast("long")
        return F.when(F.size(w) < width, none).otherwise(_let(hashes, counted))

    return _let(words, of)


def stop_words() -> list[str]:
    """Frequent words in the forms that are looked for."""
    return list(dict.fromkeys(form for w in STOP_WORDS for form in (w, w.capitalize(), w.upper())))


def quality_counts(text: Column | str) -> dict[str, Column]:
    """The counts that rules refer to, as columns over a text column."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    words = F.array_remove(F.split(text, f"[{_escaped(SPACES)}]+"), "")
    plain = text
    for symbol in SYMBOLS:
        plain = F.replace(plain, F.lit(symbol), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{_escaped(SPACES)}]"))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": (F.octet_length(text) - F.octet_length(plain)).cast("long"),
        "n_stop_words": F.size(F.filter(words, lambda x: x.isin(stop_words()))).cast("long"),
        "n_latin_words": F.when(4 * F.octet_length(text) <= 5 * F.length(text), F.size(words)).otherwise(0).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_ellipsis_lines": F.size(F.filter(lines, lambda x: F.rtrim(x).endswith("..."))).cast("long"),
        "n_repeat_words": _repeated_words(words),
    }


def _escaped(characters: str) -> str:
    return "".join(f"\\x{ord(c):02X}" for c in characters)


def verdicts(rules: list[Rule] = RULES) -> dict[str, Column]:
    """For each rule, whether the counts pass it."""
    out = {}
    for rule in rules:
        count, of = F.col(rule.count), F.col(rule.of)
        checks = []
        if rule.least is not None:
            checks.append(count >= rule.least * of)
        if rule.most is not None:
            checks.append(count <= rule.most * of)
        passed = checks[0]
        for check in checks[1:]:
            passed = passed & check
        out[rule.name] = passed
    return out


def quality(docs: DataFrame, keep: list[Column], text_col: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """``keep`` and, for every row, the counts, ``base_failed``, ``failed_rules`` and ``kept``."""
    counts = quality_counts(text_col)
    kept_names = [f"__keep{i}" for i in range(len(keep))]
    counted = docs.select(*[c.alias(n) for c, n in zip(keep, kept_names, strict=True)], *[c.alias(n) for n, c in counts.items()])
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    failed = F.filter(F.array(*[F.when(~ok, F.lit(name)) for name, ok in verdicts(rules).items()]), lambda x: x.isNotNull())
    judged = counted.select("*", base.alias("base_failed"), failed.alias("failed_rules"))
    names = [docs.select(c).columns[0] for c in keep]
    return judged.select(
        *[F.col(n).alias(name) for n, name in zip(kept_names, names, strict=True)],
        *counts,
        "base_failed",
        "failed_rules",
        (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"),
    )
