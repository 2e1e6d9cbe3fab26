"""Column functions on text and token arrays. All are built-in Spark expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 characters on which str.split() breaks, as a regular expression.
WHITESPACE = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)

# A run of any other characters: the gaps between those above. The ranges at the end are
# tried first and hold nearly all text; a negated class would take several times as long.
TOKEN = (
    r"[\x00-\x08\x0e-\x1b\x{86}-\x{9f}\x{1681}-\x{1fff}\x{200b}-\x{2027}"
    r"\x{202a}-\x{202e}\x{2030}-\x{205e}\x{2060}-\x{2fff}\x{3001}-\x{10ffff}"
    r"\x{a1}-\x{167f}!-\x{84}]+"
)

# Sentence start, sentence end, unknown word.
BOS, EOS, UNK = "<s>", "</s>", "<unk>"
SYMBOLS = (BOS, EOS, UNK)

ORDER = 5


def tokenize(text: Column) -> Column:
    """The runs of characters that are not Unicode whitespace; null has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))


# A text beyond this size is cut into pieces of so many tokens.
LONG_BYTES = 1 << 20
PIECE = 4096


def cuts(
    text: Column, order: int = ORDER, long_bytes: int = LONG_BYTES, tokens: int = PIECE
) -> list[Column]:
    """``cut``, pieces of ``tokens`` tokens each of a text longer than ``long_bytes``, and ``ends``,
    the last ``order - 1`` tokens of each; null for other texts."""
    token = f"{TOKEN}+(?:{WHITESPACE}+)?+"  # possessive: a piece is matched without going back
    pattern = F.lit(f"(?:{token}){{1,{tokens - order + 1}}}+((?:{token}){{0,{order - 1}}}+)")
    long = F.octet_length(text) > long_bytes
    found = (F.regexp_extract_all(text, pattern, F.lit(group)) for group in (0, 1))
    return [F.when(long, column).alias(name) for name, column in zip(("cut", "ends"), found)]


def pieces(text: Column, tokens: int = PIECE) -> Column:
    """An array of structs ``text``, ``before``, ``first``, ``last``, ``rest``: the text itself, or what
    ``cuts`` made of it, taken from columns ``cut`` and ``ends``.

    ``before`` are the tokens in front of a piece that its first grams reach back to, ``rest`` is
    the number of tokens in front of it. No array of all tokens of a long text is built.
    """
    yes, no, n = F.lit(True), F.lit(False), F.size("cut")
    names = ("text", "before", "first", "last", "rest")

    def piece(*parts: Column) -> Column:
        return F.struct(*[part.alias(name) for part, name in zip(parts, names)])

    last = F.concat(F.array_repeat(no, n - 1), F.array(yes))
    before = F.slice(F.concat(F.array(F.lit("")), "ends"), 1, n)
    every = F.transform(
        F.arrays_zip(F.col("cut").alias("part"), before.alias("before"), last.alias("last")),
        lambda x, i: piece(x["part"], x["before"], i == 0, x["last"], i.cast("long") * F.lit(tokens)),
    )
    whole = F.array(piece(text, F.lit(""), yes, yes, F.lit(0).cast("long")))
    return F.when(n > 0, every).otherwise(whole)


def empty_to_unk(words: Column) -> Column:
    """A segment without tokens is scored as one unknown word."""
    return F.when(F.size(words) == 0, F.array(F.lit(UNK))).otherwise(words)


def skip_symbols(words: Column) -> Column:
    """Drop the three reserved symbols, so that their neighbours become adjacent."""
    for symbol in SYMBOLS:
        words = F.array_remove(words, symbol)
    return words


def hide_symbols(words: Column) -> Column:
    """Reserved symbols that occur in a text to be scored count as unknown words."""
    present = F.lit(False)
    for symbol in SYMBOLS:
        present = present | F.array_contains(words, symbol)
    hidden = F.transform(words, lambda w: F.when(w.isin(*SYMBOLS), F.lit(UNK)).otherwise(w))
    return F.when(present, hidden).otherwise(words)


def pad_sentence(words: Column) -> Column:
    return F.concat(F.array(F.lit(BOS)), words, F.array(F.lit(EOS)))


def endings(tokens: Column, order: int = ORDER) -> Column:
    """For each token, the token and the up to ``order - 1`` tokens before it.

    An array of structs ``t0`` (the token), ``t1`` (the one before), ...; null where the
    sentence has not begun. Copies of the array, each shifted by one more place, are zipped,
    so the work grows linearly with the length of the segment. The last ``order - 1``
    entries lie past the end; their ``t0`` is null.
    """
    nothing = F.lit(None).cast("string")
    shifted = [tokens] + [F.concat(F.array(*[nothing] * k), tokens) for k in range(1, order)]
    return F.arrays_zip(*[column.alias(f"t{k}") for k, column in enumerate(shifted)])


def gram_ending(n: int, token: Callable[[str], Column] = F.col) -> Column:
    """The gram of order ``n`` that ends at one token, from its ``endings`` fields; null
    where the sentence is too short, because ``concat`` is null as soon as a part is."""
    parts = [token(f"t{n - 1}")]
    for k in range(n - 2, -1, -1):
        parts += [F.lit(" "), token(f"t{k}")]
    return F.concat(*parts)


def grams_ending(token: Callable[[str], Column] = F.col, order: int = ORDER) -> Column:
    """The grams of order 1..``order`` that end at one token: structs ``n, gram``."""
    return F.array(
        *[
            F.struct(F.lit(n).alias("n"), gram_ending(n, token).alias("gram"))
            for n in range(1, order + 1)
        ]
    )


def ngrams(tokens: Column, order: int = ORDER) -> Column:
    """All n-grams of a token array, n = 1..``order``, as an array of structs ``n, gram``."""
    by_ending = F.transform(endings(tokens, order), lambda e: grams_ending(e.getField, order))
    return F.filter(F.flatten(by_ending), lambda g: g["gram"].isNotNull())


def context_of(gram: str = "gram", n: str = "n") -> Column:
    """A gram without its last token; the empty string for a unigram."""
    return F.expr(f"substring_index({gram}, ' ', {n} - 1)")


def suffix_of(gram: str = "gram", n: str = "n") -> Column:
    """A gram without its first token; the empty string for a unigram."""
    return F.expr(f"substring_index({gram}, ' ', 1 - {n})")


def perplexity(logp: Column, positions: Column) -> Column:
    """Perplexity from a total log10 probability and the number of scored positions."""
    return F.pow(F.lit(10.0), -logp / positions)
