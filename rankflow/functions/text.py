"""Text column functions: tokenizers, keyword filters, colours (f01-f13, f23, f24).

All are native Catalyst expressions (regex, higher-order array functions), so
they run inside whole-stage codegen with no Python on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the reference's for identical results.
# Keyword token rule: keep a token when it has a Hangul syllable or is purely
# Latin letters, and it is not a letter/digit mix.
HANGUL = "[가-힣]"
LATIN_WORD = "^[a-zA-Z]+$"
LETTER_DIGIT_MIX = "[a-zA-Z].*[0-9]|[0-9].*[a-zA-Z]"
# Secondary split: any character outside Hangul syllables, Latin letters, digits.
SYMBOL_SPLIT = "[^가-힣a-zA-Z0-9]"
# Name cleaner: delete everything outside Latin letters, Hangul, digits, whitespace.
NAME_JUNK = "[^a-zA-Z가-힣0-9\\s]"
# Keyword normaliser: keep Hangul syllables and Latin letters only.
KEYWORD_JUNK = "[^가-힣a-zA-Z]"
# Colour dictionary, in match order (English then Korean).
COLORS = ("black", "brown", "blue", "green", "grey", "charcoal", "white", "navy",
          "블랙", "브라운", "블루", "그린", "그레이", "차콜", "화이트", "네이비")
COLOR_SEPARATOR = " | "
# Trending marker text.
TRENDING_MARK = "급상승"
# ---------------------------------------------------------------------------


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Spark ML's default English stop words, in its order.
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself
it its itself they them their theirs themselves what which who whom this that these those am is are was were be
been being have has had having do does did doing a an the and but if or because as until while of at by for with
about against between into through during before after above below to from up down in out on off over under
again further then once here there when where why how all any both each few more most other some such no nor not
only own same so than too very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd
he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot
could here's how's let's ought that's there's what's when's where's who's why's would
""".split()


def english_stop_words() -> tuple[str, ...]:
    """Spark ML's default English stop words (``StopWordsRemover``'s list), as a constant."""
    return tuple(ENGLISH_STOP_WORDS)


def split_space(c: Column | str) -> Column:
    """f01: split on one space (consecutive spaces give empty tokens)."""
    return F.split(_c(c), " ")


def is_keyword_token(x: Column) -> Column:
    """f02 predicate on one token."""
    return (x.rlike(HANGUL) | x.rlike(LATIN_WORD)) & ~x.rlike(LETTER_DIGIT_MIX)


def keyword_tokens(c: Column | str) -> Column:
    """f02: tokens of a product name that qualify as keywords (order kept)."""
    return F.filter(split_space(c), is_keyword_token)


def strip_symbols(arr: Column | str, chars: str = "|") -> Column:
    """f03: delete ``chars`` inside every token, trim, drop blanks (p04).

    Only ``|`` is deleted by default: that is what the reference's bracket
    pattern does after SQL unescaping (brackets survive, see f04).
    """
    cls = "[" + "".join("\\" + ch for ch in chars) + "]"
    cleaned = F.transform(_c(arr), lambda x: F.trim(F.regexp_replace(x, cls, "")))
    return drop_blank(cleaned)


def drop_blank(arr: Column | str) -> Column:
    """p04: remove tokens that are empty after trimming, in place (no explode)."""
    return F.filter(_c(arr), lambda x: F.trim(x) != "")


def split_symbols(arr: Column | str, pattern: str = SYMBOL_SPLIT) -> Column:
    """f04: split every token at symbols, trim, flatten, drop blanks."""
    parts = F.flatten(F.transform(_c(arr), lambda x: F.split(x, pattern)))
    return drop_blank(F.transform(parts, lambda x: F.trim(x)))


def product_keywords(name: Column | str) -> Column:
    """f01-f04 composed: the keyword array of c02 in one expression."""
    return split_symbols(strip_symbols(keyword_tokens(name)))


def clean_name(c: Column | str) -> Column:
    """f05: lower-case and delete everything but letters, digits, Hangul, whitespace."""
    return F.regexp_replace(F.lower(_c(c)), NAME_JUNK, "")


def whitespace_tokens(c: Column | str) -> Column:
    """f06: split on whitespace runs; a leading blank yields an empty first token."""
    return F.split(_c(c), "\\s+")


def remove_stop_words(arr: Column | str, words: Sequence[str] | None = None) -> Column:
    """f07: drop stop words, case-insensitively (StopWordsRemover semantics)."""
    stop = [w.lower() for w in (words or ENGLISH_STOP_WORDS)]
    # a long literal list is a hash-set probe per token
    return F.filter(_c(arr), lambda x: ~F.lower(x).isin(stop))


def array_to_text(arr: Column | str, sep: str = ",") -> Column:
    """f08: join an array into text."""
    return F.concat_ws(sep, _c(arr))


def text_to_array(c: Column | str, sep: str = ", ") -> Column:
    """f09: split text on a literal separator."""
    import re

    return F.split(_c(c), re.escape(sep))


def normalise_keyword(c: Column | str) -> Column:
    """f11: lower-case and strip all but Latin letters and Hangul."""
    return F.regexp_replace(F.lower(_c(c)), KEYWORD_JUNK, "")


def keep_vocabulary(arr: Column | str, vocabulary: Column | str) -> Column:
    """f12: keep elements found in ``vocabulary`` (an array column), duplicates kept.

    A vocabulary computed by a scalar subquery must first be bound to a column
    (subqueries are not allowed inside lambdas): see :func:`with_vocabulary`.
    """
    return F.filter(_c(arr), lambda x: F.array_contains(_c(vocabulary), x))


def extract_colors(name: Column | str, colors: Sequence[str] = COLORS,
                   sep: str = COLOR_SEPARATOR) -> Column:
    """f13: dictionary colours contained in the lower-cased name, in dictionary
    order, joined by ``sep``; NULL when none is found."""
    low = F.lower(_c(name))
    # concat_ws skips NULLs: one codegen'd expression, no per-row array or lambda.
    found = F.concat_ws(sep, *[F.when(F.contains(low, F.lit(x)), F.lit(x)) for x in colors])
    return F.nullif(found, F.lit(""))


def trending_flag(text: Column | str, mark: str = TRENDING_MARK) -> Column:
    """f23: 1 when the text contains the trending marker, else 0 (NULL -> 0)."""
    return F.coalesce(F.contains(_c(text), F.lit(mark)), F.lit(False)).cast("int")


def strip_text(c: Column | str) -> Column:
    """f24: strip leading/trailing whitespace of any kind (Python ``str.strip``)."""
    return F.regexp_replace(_c(c), "^\\s+|\\s+$", "")


def with_vocabulary(df, arr: str, vocabulary: Column, out: str, tmp: str = "_vocab"):
    """f12 on a DataFrame: bind the (bounded) vocabulary array, then filter ``arr``."""
    return df.withColumn(tmp, vocabulary).withColumn(out, keep_vocabulary(arr, tmp)).drop(tmp)


def remove_stop_words_df(df, col: str, out: str, words: Sequence[str] | None = None, case_sensitive: bool = False):
    """f07 as Spark ML's ``StopWordsRemover``; same result as :func:`remove_stop_words`."""
    from pyspark.ml.feature import StopWordsRemover

    remover = StopWordsRemover(inputCol=col, outputCol=out, caseSensitive=case_sensitive,
                               stopWords=list(words or english_stop_words()), locale="en_US")
    return remover.transform(df)
