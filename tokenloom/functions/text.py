"""String scalars: text normalisation, paths, cache keys."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from tokenloom.functions.util import col_of, cuts, offsets_of

# Code-point substitutions applied before tokenising text,
# code point -> replacement, in ascending code-point order. 2122 is a decimal
# code point (U+084A), so the trademark sign U+2122 itself is left alone.
CHAR_SUBSTITUTIONS: dict[int, str] = {
    180: "'",
    2122: "TM",
    8175: "'",
    8189: "'",
    8190: "'",
    8208: "-",
    8209: "-",
    8210: "-",
    8211: "-",
    8212: "-",
    8213: "-",
    8214: "||",
    8216: "'",
    8217: "'",
    8218: ",",
    8219: "`",
    8220: '"',
    8221: '"',
    8222: ",,",
    8223: '"',
    8228: ".",
    8229: "..",
    8230: "...",
    8242: "'",
    8243: '"',
    8245: "'",
    8246: '"',
}

# The code points Python's str.isspace() accepts. Spark's one-argument
# trim() only strips U+0020 and Java's \s is ASCII-only, so the set is explicit.
WHITESPACE_CODEPOINTS = (
    [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680]
    + list(range(0x2000, 0x200B))
    + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
WHITESPACE_CHARS = "".join(chr(c) for c in WHITESPACE_CODEPOINTS)
WHITESPACE_CLASS = "[" + "".join(f"\\x{{{c:X}}}" for c in WHITESPACE_CODEPOINTS) + "]"

# Characters turned into a space before stripping (tab, newline, asterisk).
SPACE_CHARS = "\t\n*"


def one_to_one() -> tuple[str, str]:
    src = "".join(chr(cp) for cp, rep in CHAR_SUBSTITUTIONS.items() if len(rep) == 1)
    dst = "".join(rep for rep in CHAR_SUBSTITUTIONS.values() if len(rep) == 1)
    return src, dst


def one_to_many() -> list[tuple[str, str]]:
    return [(chr(cp), rep) for cp, rep in CHAR_SUBSTITUTIONS.items() if len(rep) > 1]


#: Bytes of text that are normalised at once, whatever the batch they come from.
BYTES_AT_ONCE = 1 << 20


def normalize_text(text) -> Column:
    """Substitutions, tab/newline/'*' -> space, strip, collapse 2+ whitespace."""
    return _normalized(col_of(text).cast("string"))


_REPLACED = {**{chr(cp): rep for cp, rep in CHAR_SUBSTITUTIONS.items()}, **dict.fromkeys(SPACE_CHARS, " ")}
_REPLACE = re.compile("[" + re.escape("".join(_REPLACED)) + "]")
_RUN = re.compile("[" + re.escape(WHITESPACE_CHARS) + "]{2,}")


def normalized(text: str) -> str:
    """P1 of one text; no replacement holds a character that is replaced, so one pass does for all."""
    text = _REPLACE.sub(lambda m: _REPLACED[m[0]], text)
    return _RUN.sub(" ", text.strip(WHITESPACE_CHARS))


@F.arrow_udf(StringType())
def _normalized(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for b in batches:
        for i, j in cuts(offsets_of(b), BYTES_AT_ONCE):
            yield pa.array([None if s is None else normalized(s) for s in b.slice(i, j - i).to_pylist()], pa.string())


def normalize_texts(texts) -> Column:
    """P1 of every text of an array: several texts of a row take one Python step, not one each."""
    return _normalized_all(col_of(texts))


@F.arrow_udf(ArrayType(StringType()))
def _normalized_all(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for b in batches:
        for part, at, flat in text_lists(b, BYTES_AT_ONCE):
            yield pa.ListArray.from_arrays(pa.array(at), pa.array([None if s is None else normalized(s) for s in flat.to_pylist()], pa.string()),
                                           mask=part.is_null())


def text_lists(b: pa.Array, limit: int) -> Iterator[tuple[pa.Array, np.ndarray, pa.Array]]:
    """Parts of at most ``limit`` bytes of text (or one row) of an array of text lists, the offsets of their rows and their texts."""
    for i, j in cuts(offsets_of(b.values)[offsets_of(b)], limit):
        part = b.slice(i, j - i)
        at = offsets_of(part)
        yield part, at - at[0], part.values.slice(at[0], at[-1] - at[0])


def wide_chars(text) -> Column:
    """Distinct characters with a code point >= 256, in code-point order."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(col_of(text), F.lit(r"[^\x{00}-\x{FF}]"), 0)))


def artifact_path(base, kind: str, key) -> Column:
    """``base/<dir>/<key><ext>`` for the four artifact kinds."""
    folder, ext = ARTIFACT_KINDS[kind]
    return F.concat(col_of(base), F.lit(f"/{folder}/"), col_of(key), F.lit(ext))


# Artifact kind -> (folder, file extension).
ARTIFACT_KINDS = {
    "wav": ("wav", ".wav"),
    "codes": ("tok", ".tok"),
    "embedding": ("emb", ".emb"),
    "text": ("txt", ".pt"),
}


def parent_dirs(path) -> Column:
    """All ancestor directories, nearest first, excluding '/' and ''.

    The k-th parent drops the last k slash-separated components (a run of slashes is one
    separator; slashes inside the kept head stay as they are), like a repeated dirname.
    """
    p = col_of(path)
    runs = F.size(F.split(p, "/+", -1)) - 1
    parents = F.transform(
        F.sequence(F.lit(1), F.greatest(runs, F.lit(1))),
        lambda k: F.regexp_replace(p, F.concat(F.lit("(/+[^/]*){"), k.cast("string"), F.lit("}$")), F.lit("")),
    )
    return F.when(runs < 1, F.array().cast("array<string>")).otherwise(F.filter(parents, lambda d: d != ""))


def result_name(text, ident) -> Column:
    """P5: ``synth_`` + first 25 chars of text (spaces -> '_') + '_' + id; ``synth_<id>`` when
    there is no text to use."""
    i = col_of(ident).cast("string")
    with_text = F.concat(F.lit("synth_"), F.substring(F.replace(col_of(text), F.lit(" "), F.lit("_")), 1, 25),
                         F.lit("_"), i)
    return F.coalesce(with_text, F.concat(F.lit("synth_"), i))


def file_extension(path) -> Column:
    """Suffix of the last path segment (query string included), as a path library reports it.

    Trailing slashes are ignored; a leading dot or a trailing dot gives ''.
    """
    trimmed = F.regexp_replace(col_of(path), "/+$", "")
    return F.regexp_extract(trimmed, r"[^/](\.[^./]+)$", 1)


def split_ext(path) -> tuple[Column, Column]:
    """(stem, extension) of the base name, with splitext rules: leading dots never start
    an extension, a trailing dot is an extension of its own."""
    base = F.element_at(F.split(col_of(path), "/", -1), -1)
    ext = F.regexp_extract(base, r"^\.*[^.].*(\.[^.]*)$", 1)
    stem = F.substring(base, F.lit(1), F.length(base) - F.length(ext))
    return stem, ext


def tagged_output_path(path, tag: str, ext: str | None = None) -> Column:
    """``./enhanced/`` + stem + tag + (ext or the original extension)."""
    stem, orig_ext = split_ext(path)
    return F.concat(F.lit("./enhanced/"), stem, F.lit(tag), F.lit(ext) if ext else orig_ext)


def ensure_suffix(path, suffix: str = ".wav") -> Column:
    """Append ``suffix`` unless present; null stays null."""
    c = col_of(path)
    return F.when(c.endswith(suffix), c).otherwise(F.concat(c, F.lit(suffix)))


def cache_key(uri) -> Column:
    """``audio_<md5><ext>`` for http(s) URIs, ``embedding_<md5>.pt`` otherwise."""
    c = col_of(uri)
    return F.when(
        c.startswith("http"), F.concat(F.lit("audio_"), F.md5(c), file_extension(c))
    ).otherwise(F.concat(F.lit("embedding_"), F.md5(c), F.lit(".pt")))


def infer_format(path) -> Column:
    """Lower-cased text after the last dot."""
    return F.lower(F.element_at(F.split(col_of(path), r"\.", -1), -1))
