"""Text analysis: tokens of documents, terms of queries, stopwords, stemming."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

from ..errors import QueryError

# The default English stopwords.
ENGLISH = frozenset(
    """
    a about above after again against ain all am an and any are aren aren't as at be because been
    before being below between both but by can couldn couldn't d did didn didn't do does doesn
    doesn't doing don don't down during each few for from further had hadn hadn't has hasn hasn't
    have haven haven't having he he'd he'll he's her here hers herself him himself his how i i'd
    i'll i'm i've if in into is isn isn't it it'd it'll it's its itself just ll m ma me mightn
    mightn't more most mustn mustn't my myself needn needn't no nor not now o of off on once only
    or other our ours ourselves out over own re s same shan shan't she she'd she'll she's should
    should've shouldn shouldn't so some such t than that that'll the their theirs them themselves
    then there these they they'd they'll they're they've this those through to too under until up
    ve very was wasn wasn't we we'd we'll we're we've were weren weren't what when where which
    while who whom why will with won won't wouldn wouldn't y you you'd you'll you're you've your
    yours yourself yourselves
    """.split()
)

# A query token holding one of these is never a stopword and never weighted.
SPECIAL_CHARACTERS = ",.<>{}[]\\\"':;!@#$%^&*()-+=~/ ?"

# Java regular expressions.
_SEPARATOR = r"[^\p{L}\p{N}]+"
_SPECIAL = "[" + "".join("\\" + c for c in SPECIAL_CHARACTERS) + "]"


def resolve_stopwords(stopwords: str | Iterable[str] | None) -> frozenset[str]:
    """``'english'``, a replacement list, or ``None`` for no stopwords."""
    if stopwords is None:
        return frozenset()
    if isinstance(stopwords, str):
        if stopwords != "english":
            raise QueryError(f"No stopword list for {stopwords!r}")
        return ENGLISH
    words = list(stopwords)
    for word in words:
        if not isinstance(word, str):
            raise QueryError(f"A stopword must be a string, not {type(word).__name__}")
    return frozenset(words)


def tokens(text: Column, stem: bool = False) -> Column:
    """The token array of a text column: runs of letters and digits, lowercased."""
    words = F.filter(F.split(F.lower(text), _SEPARATOR), lambda t: t != "")
    return stemmed(words) if stem else words


def literal_tokens(text: str) -> list[str]:
    """:func:`tokens` for a value known while the query is built."""
    kept = (c if unicodedata.category(c)[0] in "LN" else " " for c in text.lower())
    return "".join(kept).split()


def query_tokens(text: Column) -> Column:
    """Query tokens: split on white space, outer commas and curly quotes removed, lowercased."""
    raw = F.split(text, r"\s+")
    clean = F.transform(
        raw, lambda t: F.lower(F.regexp_replace(F.regexp_replace(F.trim(t), "^,+|,+$", ""), "[“”]", ""))
    )
    return F.filter(clean, lambda t: t != "")


def is_plain(token: Column) -> Column:
    """Whether a query token has no special character."""
    return ~token.rlike(_SPECIAL)


def phrase_match(token_array: Column, phrase: list[str]) -> Column:
    """Whether ``phrase`` occurs as consecutive tokens."""
    if not phrase:
        return F.lit(False)
    if len(phrase) == 1:
        return F.array_contains(token_array, phrase[0])
    padded = F.concat(F.lit(" "), F.array_join(token_array, " "), F.lit(" "))
    return padded.contains(" " + " ".join(phrase) + " ")


def shingles(token_array: Column, lengths: Iterable[int]) -> Column:
    """All runs of the given lengths as space-joined terms; length 1 is the token itself."""
    parts = [token_array if n == 1 else _runs(token_array, n) for n in sorted(set(lengths))]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def _runs(token_array: Column, n: int) -> Column:
    """Neighbouring tokens joined pairwise, so the array is never read inside a lambda."""
    size = F.size(token_array)
    run = token_array
    for at in range(1, n):
        rest = F.slice(token_array, F.lit(at + 1), F.greatest(size - at, F.lit(0)))
        run = F.zip_with(run, rest, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.filter(run, lambda r: r.isNotNull())


@F.arrow_udf(T.ArrayType(T.StringType()))
def stemmed(words: pa.Array) -> pa.Array:
    """Porter stems of a token array column; each distinct word of a batch is stemmed once."""
    flat = words.flatten().dictionary_encode()
    stems = pa.array([porter_stem(w) for w in flat.dictionary.to_pylist()], pa.string())
    values = stems.take(flat.indices)
    lengths = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    offsets = [0, *lengths.cumsum().tolist()]
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
    if words.null_count:
        import pyarrow.compute as pc

        lists = pc.if_else(words.is_valid(), lists, pa.scalar(None, lists.type))
    return lists


# Suffix tables of the published Porter (1980) algorithm.
_STEP2 = (
    "ational:ate tional:tion enci:ence anci:ance izer:ize abli:able alli:al entli:ent eli:e ousli:ous "
    "ization:ize ation:ate ator:ate alism:al iveness:ive fulness:ful ousness:ous aliti:al iviti:ive biliti:ble"
)
_STEP3 = "icate:ic ative: alize:al iciti:ic ical:ic ful: ness:"
_STEP4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"


def _table(text: str) -> list[tuple[str, str]]:
    pairs = [tuple(p.split(":")) for p in text.split()]
    return sorted(pairs, key=lambda p: -len(p[0]))


_STEP2_TABLE, _STEP3_TABLE = _table(_STEP2), _table(_STEP3)
_STEP4_TABLE = sorted(_STEP4.split(), key=len, reverse=True)


def _shape(word: str) -> str:
    out = ""
    for i, c in enumerate(word):
        vowel = c in "aeiou" or (c == "y" and i > 0 and out[-1] == "c")
        out += "v" if vowel else "c"
    return out


def _measure(word: str) -> int:
    return _shape(word).count("vc")


def _cvc(word: str) -> bool:
    return _shape(word)[-3:] == "cvc" and word[-1] not in "wxy"


def _double(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def porter_stem(word: str) -> str:
    """Stem of one lowercase word; words that are not ASCII letters are kept."""
    if len(word) < 3 or not (word.isascii() and word.isalpha()):
        return word
    if word.endswith(("sses", "ies")):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    if word.endswith("eed"):
        if _measure(word[:-3]) > 0:
            word = word[:-1]
    else:
        for suffix in ("ed", "ing"):
            base = word[: -len(suffix)]
            if word.endswith(suffix):
                if "v" in _shape(base):
                    word = base
                    if word.endswith(("at", "bl", "iz")):
                        word += "e"
                    elif _double(word) and word[-1] not in "lsz":
                        word = word[:-1]
                    elif _measure(word) == 1 and _cvc(word):
                        word += "e"
                break
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    for table in (_STEP2_TABLE, _STEP3_TABLE):
        for suffix, replacement in table:
            if word.endswith(suffix):
                if _measure(word[: -len(suffix)]) > 0:
                    word = word[: -len(suffix)] + replacement
                break
    for suffix in _STEP4_TABLE:
        if word.endswith(suffix):
            base = word[: -len(suffix)]
            if _measure(base) > 1 and (suffix != "ion" or base.endswith(("s", "t"))):
                word = base
            break
    if word.endswith("e"):
        m = _measure(word[:-1])
        if m > 1 or (m == 1 and not _cvc(word[:-1])):
            word = word[:-1]
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


def phonetic(words: Column) -> Column:
    """Soundex codes of a token array."""
    return F.transform(words, F.soundex)


def analysed(text: Column, stem: bool = False, sound: bool = False) -> Column:
    """Tokens after the optional stemming and phonetic steps."""
    words = tokens(text, stem)
    return phonetic(words) if sound else words


def max_frequency(words: Column) -> Column:
    """How often the most frequent token of a token array occurs; 0 for none."""
    none = F.struct(F.lit("").alias("word"), F.lit(0).alias("run"), F.lit(0).alias("most"))

    def counted(state: Column, word: Column) -> Column:
        run = F.when(word == state["word"], state["run"] + 1).otherwise(F.lit(1))
        return F.struct(word.alias("word"), run.alias("run"), F.greatest(state["most"], run).alias("most"))

    return F.coalesce(F.aggregate(F.array_sort(words), none, counted, lambda state: state["most"]), F.lit(0))


# Tokens that are numbered and sorted at a time.
_TOKENS = 300_000

_POSTING = T.StructType(
    [
        T.StructField("term", T.StringType()),
        T.StructField("tf", T.IntegerType()),
        T.StructField("positions", T.ArrayType(T.IntegerType())),
    ]
)


@F.arrow_udf(T.ArrayType(_POSTING))
def term_positions(words: pa.Array) -> pa.Array:
    """The distinct terms of a token array with their counts and positions.

    A document is one row, so its postings need no shuffle: the tokens of some rows of
    a batch at a time are numbered once and sorted by row and number.
    """
    lengths = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    terms, counts, positions, per_row = [pa.array([], pa.string())], [], [], []
    at = 0
    while at < len(lengths):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + _TOKENS, side="right")))
        some = _sorted_terms(words.slice(at, to - at), lengths[at:to])
        for whole, part in zip((terms, counts, positions, per_row), some, strict=True):
            whole.append(part)
        at = to
    tf, place, held = (np.concatenate([np.zeros(0, np.int32), *parts]) for parts in (counts, positions, per_row))
    starts = lambda sizes: pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    places = pa.ListArray.from_arrays(starts(tf), pa.array(place))
    entries = pa.StructArray.from_arrays([pa.concat_arrays(terms), pa.array(tf), places], names=["term", "tf", "positions"])
    return pa.ListArray.from_arrays(starts(held), entries)


def _sorted_terms(words: pa.Array, lengths: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Terms and their counts by row, the positions in the order of these, and the number of terms of each row."""
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    flat = words.flatten().dictionary_encode()
    if isinstance(flat, pa.ChunkedArray):
        flat = flat.combine_chunks()
    codes = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    position = np.arange(len(codes)) - offsets[row]
    group = row * max(1, len(flat.dictionary)) + codes
    order = np.argsort(group, kind="stable")
    first = np.flatnonzero(np.diff(group[order], prepend=-1))
    tf = np.diff(first, append=len(order)).astype(np.int32)
    terms = flat.dictionary.take(pa.array(codes[order][first]))
    held = np.bincount(row[order][first], minlength=len(lengths)).astype(np.int32)
    return terms, tf, position[order].astype(np.int32), held
