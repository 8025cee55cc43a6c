"""SQL text for the oracle side: the same derivations written for DuckDB.

These strings are what ``oracle_sql()`` hands to DuckDB; they never run on Spark.
They restate the operator semantics independently with DuckDB list functions
(1-based lists, ``lambda x: ...`` syntax).
"""

from __future__ import annotations

from tokenloom.functions.text import CHAR_SUBSTITUTIONS, SPACE_CHARS
from tokenloom.layout import BYTE_EOT, STAGE1

W = (r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
     r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def normalize(expr: str) -> str:
    src = "".join(chr(cp) for cp, r in CHAR_SUBSTITUTIONS.items() if len(r) == 1) + SPACE_CHARS
    dst = "".join(r for r in CHAR_SUBSTITUTIONS.values() if len(r) == 1) + " " * len(SPACE_CHARS)
    e = f"translate({expr}, {q(src)}, {q(dst)})"
    for cp, r in CHAR_SUBSTITUTIONS.items():
        if len(r) > 1:
            e = f"replace({e}, {q(chr(cp))}, {q(r)})"
    e = f"regexp_replace({e}, '^{W}+|{W}+$', '', 'g')"
    return f"regexp_replace({e}, '{W}{{2,}}', ' ', 'g')"


def rep(value: str, count: str) -> str:
    return f"list_transform(range(greatest(({count})::BIGINT, 0)), lambda _i: {value})"


def byte_tokens(expr: str, offset: int = STAGE1.text_offset) -> str:
    ids = f"list_transform(regexp_extract_all(hex(encode({expr})), '..'), lambda h: ('0x' || h)::INTEGER + {offset})"
    return f"list_concat({ids}, [{BYTE_EOT + offset}])"


def codes(doc_id: str = "doc_id", n: int = 8) -> str:
    t = f"(30 + {doc_id} % 50)"
    return (f"list_transform(range({n}), lambda b: list_transform(range({t}), "
            f"lambda f: (({doc_id} * 31 + b * 17 + f * 7) % 1024)::INTEGER))")


def interleave(c: str, vocab: int = 1024) -> str:
    return (f"flatten(list_transform(range(1, len({c}[1]) + 1), "
            f"lambda i: [{c}[1][i], {c}[2][i] + {vocab}]))")


def key(src: str = "source", doc: str = "doc_id") -> str:
    return f"({src} || '/' || CAST({doc} AS VARCHAR))"


MANIFEST = f"SELECT {key()} AS key, text, doc_id AS pos FROM documents"
CODE_ART = f"SELECT {key()} AS key, {codes()} AS codes FROM documents"
TEXT_ART = f"SELECT {key()} AS key, {byte_tokens(normalize('text'))} AS tokens FROM documents"
EMB_ART = (f"SELECT {key('d.source', 'd.doc_id')} AS key, e.embedding FROM embeddings e "
           f"JOIN documents d ON e.vec_id = d.doc_id")


def unit(expr: str) -> str:
    """Uniform [0,1) from md5, matching ``hash_unit`` on the Spark side."""
    return f"(('0x' || substr(md5({expr}), 1, 13))::BIGINT::DOUBLE / {float(16 ** 13)!r})"


# Python json.dumps (ensure_ascii) escaping of one character ``ch``
_JSON_ESC = r"""CASE WHEN ch = '"' THEN '\"' WHEN ch = '\' THEN '\\' WHEN ch = chr(10) THEN '\n'
  WHEN ch = chr(13) THEN '\r' WHEN ch = chr(9) THEN '\t' WHEN ch = chr(8) THEN '\b' WHEN ch = chr(12) THEN '\f'
  WHEN unicode(ch) BETWEEN 32 AND 126 THEN ch
  WHEN unicode(ch) < 65536 THEN '\u' || lpad(lower(printf('%x', unicode(ch))), 4, '0')
  ELSE '\u' || lower(printf('%04x', 55296 + ((unicode(ch) - 65536) >> 10)))
       || '\u' || lower(printf('%04x', 56320 + ((unicode(ch) - 65536) & 1023))) END"""


def json_string(expr: str) -> str:
    """Python ``json.dumps`` (ensure_ascii) of a string expression."""
    body = f"array_to_string(list_transform(string_split({expr}, ''), lambda ch: {_JSON_ESC}), '')"
    return f"""(CASE WHEN ({expr}) IS NULL THEN 'null' WHEN ({expr}) = '' THEN '""' ELSE '"' || {body} || '"' END)"""
