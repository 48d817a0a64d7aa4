"""Quality rules (operator 4): base rules on counts, then the divergence of a
document's histograms from those of its language.

A document has two histograms: character classes, and the common words of a
language (plus one bin for all other words).  Each language's reference is the
histogram of all its documents together.  The Jensen-Shannon distance (base 2,
0 to 1) of a document to its reference must stay under a bound.  That of the words follows
from the reference: the distance of a text with hardly any of its language's common words.
Texts shorter than a bound are not judged.

Everything is built from DataFrame expressions; the references are one
aggregate with a row for each listed language (at most ``len(COMMON_WORDS)``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import SPACES
from rankflow.session import materialize

# Frequent function words, by language.
COMMON_WORDS = {
    "de": "der die das und in zu den mit von ist nicht ein eine für auf sich des dem im auch",
    "en": "the of and to in a is that for it was on with as be by at this are from",
    "es": "de la que el en y a los se del las un por con no una su para es al",
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur",
    "it": "di e il la che in un per è non una del con si da le i gli al della",
    "nl": "de het een van en in is dat op te zijn met voor niet aan er om ook als bij",
    "pt": "de a o que e do da em um para com não uma os no se na por mais as",
}
#: Characters counted by the base rules.
SYMBOLS = "#*$%&|<>"
#: Punctuation that is no part of a word at its ends.
PUNCTUATION = ".,;:!?¡¿'\"()[]{}«»„“”‘’…-"
#: Character classes, as text of a Java character class; the rest is a class of its own.
CLASSES = ("a-z", "A-Z", "0-9", " \\t\\n\\x0B\\f\\r", ".,;:!?'\"()\\-", "\\u00C0-\\u024F", "#*$%&|<>{}\\[\\]\\\\/@^_~+=")


@dataclass(frozen=True)
class QualityRules:
    """Bounds of the rules; the two distances are judged only from ``min_chars`` characters
    and ``min_words`` words on.  ``least_common``: a text of a listed language must be nearer to its
    reference than one with this part of the reference's common words; ``max_word_distance``
    holds for every text."""

    base_words: int = 50
    max_repeat_percent: int = 50
    min_chars: int = 200
    min_words: int = 50
    max_class_distance: float = 0.45
    max_word_distance: float = 0.75
    least_common: float = 0.02


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))


def _windows(words: str, n: str) -> Column:
    """64-bit hashes of all 3-word windows of a text, in order.  Only windows of one text are
    compared (two of a million unequal ones meet by chance with odds of 1 in 30 million)."""
    w = F.col(words)
    windows = F.transform(F.sequence(F.lit(1), F.col(n) - 2), lambda i: F.xxhash64(
        F.element_at(w, i), F.element_at(w, i + 1), F.element_at(w, i + 2)))
    return F.when(F.col(n) >= 4, windows).otherwise(F.array().cast("array<bigint>"))


def base_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_text`` (null: empty), ``_words`` and the base counts.

    Columns added: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long).
    Null and empty texts have zero everywhere.  All texts are taken whole.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.withColumn("_text", text).withColumn("_words", _words(F.col("_text")))
    df = df.withColumn("n_words", F.size("_words").cast("long"))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    df = df.withColumn("_lines", lines)
    df = df.withColumn("_n", F.col("n_words").cast("int")).withColumn("_windows", _windows("_words", "_n"))
    # Windows are sorted with their positions, equal neighbours are repeats, and a sweep over
    # their positions adds the words each one newly covers.  Only texts with a repeat sort.
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    pairs = F.sort_array(F.transform("_windows", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    df = df.withColumn("_sorted", F.when(repeats, pairs).otherwise(
        F.array().cast("array<struct<g:bigint,i:int>>")))
    s = F.col("_sorted")
    again = F.filter(s, lambda x, k: (F.get(s, k - 1)["g"] == x["g"]) | (F.get(s, k + 1)["g"] == x["g"]))
    at = F.sort_array(F.transform(again, lambda x: x["i"]))
    swept = F.aggregate(at, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
                        lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")))
    return df.withColumns({
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.regexp_count("_text", F.lit(f"[{SYMBOLS}]")).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": swept["n"].cast("long"),
    }).drop("_lines", "_windows", "_sorted", "_n")


def histograms(counted: DataFrame) -> DataFrame:
    """Adds ``_classes`` (array<double>, characters by class), ``_tokens`` (number of the lower-cased
    text's words between white space, without outer punctuation) and ``_common`` (those that any language lists)."""
    # one pass per class over what the classes before it left
    df, left, names = counted, "_text", []
    for k, cls in enumerate(CLASSES):
        df = df.withColumn(f"_left{k}", F.regexp_replace(left, f"[{cls}]+", ""))
        names.append(F.length(left) - F.length(f"_left{k}"))
        left = f"_left{k}"
    listed = sorted({w for words in COMMON_WORDS.values() for w in words.split()})
    # a separator: punctuation up to white space and all of both behind it (each run is read once)
    space, marks = "\\x20\\x09-\\x0D", "".join(f"\\{c}" for c in PUNCTUATION)
    separator = f"(?:(?<![{marks}])[{marks}]++)?+[{space}][{space}{marks}]*+"
    df = df.withColumn("_parts", F.split(F.btrim(F.lower("_text"), F.lit(SPACES + PUNCTUATION)), separator))
    df = df.withColumn("_classes", F.array(*[c.cast("double") for c in [*names, F.length(left)]]))
    df = df.withColumns({"_common": F.filter("_parts", lambda x: x.isin(listed)), "_tokens": F.size("_parts")})
    return df.drop("_parts", *[f"_left{k}" for k in range(len(CLASSES))])


def references(histogrammed: DataFrame) -> dict[str, tuple[list[float], list[float]]]:
    """Per listed language that has documents: its class and common-word histograms,
    summed over all its documents (one partial aggregate; a row for each language)."""
    known = histogrammed.where(F.col("lang").isin(list(COMMON_WORDS)))
    entry = lambda key, n: F.struct(key.alias("key"), n.cast("double").alias("n"))
    cells = F.concat(F.transform("_common", lambda w: entry(w, F.lit(1))), F.transform(
        "_classes", lambda n, k: entry(F.concat(F.lit("#"), k.cast("string")), n)), F.array(entry(F.lit("#tokens"), F.col("_tokens"))))
    summed = known.select("lang", F.explode(cells).alias("cell")).groupBy("lang", "cell.key").agg(F.sum("cell.n").alias("n"))
    counts: dict[str, dict[str, float]] = {}
    for r in summed.collect():  # listed languages x (listed words and classes)
        counts.setdefault(r["lang"], {})[r["key"]] = r["n"]
    out = {}
    for lang, n in counts.items():
        by_word = [n.get(w, 0.0) for w in COMMON_WORDS[lang].split()]
        out[lang] = ([n.get(f"#{k}", 0.0) for k in range(len(CLASSES) + 1)], [*by_word, max(0.0, n.get("#tokens", 0.0) - sum(by_word))])
    return out


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _js_distance(counts: Column, shares: Column, total: Column) -> Column:
    """Jensen-Shannon distance, base 2, of counts (adding up to ``total``) and shares."""
    def term(c, q):
        p = c / total
        m = (p + q) / 2
        return F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0)

    return F.sqrt(F.greatest(F.lit(0.0), _sum(F.zip_with(counts, shares, term)) / 2))


def _shares(counts: list[float]) -> list[float]:
    total = sum(counts) or 1.0
    return [c / total for c in counts]


def word_bound(shares: list[float], least_common: float) -> float:
    """Distance to a reference's word shares (the last one: all other words) of a text that has
    ``least_common`` times as many of each common word."""
    few = [least_common * q for q in shares[:-1]]
    part = lambda p, q: p * math.log2(2 * p / (p + q)) if p > 0 else 0.0
    distance = math.sqrt(max(0.0, sum(part(p, q) + part(q, p) for p, q in zip([*few, 1 - sum(few)], shares)) / 2))
    return max(distance, 1e-6)  # a reference without common words tells nothing


def quality(docs: DataFrame, rules: QualityRules = QualityRules(), columns: Sequence[str] | None = None) -> DataFrame:
    """All columns of ``docs``, or ``columns`` of them (but for those replaced), with the base
    counts, the distances and the verdict.  The result is read from a table written once.

    Added: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    class_distance and word_distance (null where not judged: a short text, or a language
    that no document's ``lang`` names; a text with an unlisted or null ``lang`` has the
    distance to the nearest reference and only ``max_word_distance`` as its bound), kept.  An empty table gives an empty result.
    """
    made = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "word_distance", "kept")
    names = [c for c in (docs.columns if columns is None else columns) if c not in made]
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    row = F.struct(*names) if names else F.struct(F.lit(0).alias("none"))  # names of the input can't meet those made here
    df = histograms(base_counts(docs.select(row.alias("row"), lang.alias("lang"), "text")))
    # Texts are read once: each row's counts are written, references and verdicts follow from them.
    df = materialize(df.select("row", "lang", *made[:5], "_classes", "_tokens", "_common", F.length("_text").alias("_chars")), "quality-counts")
    found = sorted(references(df).items())
    refs = [F.struct(F.lit(lang).alias("lang"), F.array(*map(F.lit, COMMON_WORDS[lang].split())).alias("words"),
                     F.array(*map(F.lit, _shares(classes))).alias("classes"), F.array(*map(F.lit, _shares(words))).alias("shares"))
            for lang, (classes, words) in found]
    judged = (F.col("_chars") >= rules.min_chars) & (F.col("n_words") >= rules.min_words)
    if refs:
        common, n = F.col("_common"), F.col("_tokens").cast("double")
        df = df.withColumn("_refs", F.array(*refs))
        own = F.filter("_refs", lambda r: r["lang"] == F.col("lang"))
        df = df.withColumn("_own", F.when(~judged, F.slice("_refs", 1, 0)).when(
            F.exists("_refs", lambda r: r["lang"] == F.col("lang")), own).otherwise(F.col("_refs")))
        df = df.withColumn("_own", F.transform("_own", lambda r: F.struct(
            r["classes"].alias("classes"), r["shares"].alias("shares"), F.transform(
                r["words"], lambda w: (F.size(common) - F.size(F.array_remove(common, w))).cast("double")).alias("counts"))))
        df = df.withColumn("_own", F.transform("_own", lambda r: F.struct(
            r["classes"].alias("classes"), r["shares"].alias("shares"),
            F.concat(r["counts"], F.array(F.greatest(F.lit(0.0), n - _sum(r["counts"])))).alias("counts"),
            F.greatest(n, _sum(r["counts"])).alias("total"))))
        df = df.withColumn("_own", F.transform("_own", lambda r: F.struct(
            _js_distance(F.col("_classes"), r["classes"], F.col("_chars").cast("double")).alias("c"),
            _js_distance(r["counts"], r["shares"], r["total"]).alias("w"))))
        df = df.withColumns({"class_distance": F.array_min(F.transform("_own", lambda r: r["c"])),
                             "word_distance": F.array_min(F.transform("_own", lambda r: r["w"]))}).drop("_refs", "_own")
    else:
        df = df.withColumns({"class_distance": F.lit(None).cast("double"), "word_distance": F.lit(None).cast("double")})
    failed = (F.col("n_words") < rules.base_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))
    df = df.withColumn("base_failed", failed)
    bound = F.lit(rules.max_word_distance)
    for lang, (_, words) in found:
        bound = F.when(F.col("lang") == lang, min(rules.max_word_distance, word_bound(_shares(words), rules.least_common))).otherwise(bound)
    fine = (F.coalesce(F.col("class_distance"), F.lit(0.0)) <= rules.max_class_distance) & (
        F.coalesce(F.col("word_distance"), F.lit(0.0)) <= bound)
    return df.withColumn("kept", ~F.col("base_failed") & fine).select(*(["row.*"] if names else []), *made)
