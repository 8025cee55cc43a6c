"""URL filters: domain and path rules, then a weighted URL vocabulary.

The vocabulary has strict and soft terms, soft ones with a weight. One Aho-Corasick automaton finds every term in the
lower-cased URL; an occurrence counts only between boundaries (no ASCII letter or digit on either
side). A URL is blocked on one strict term, or on ``SOFT_HITS`` distinct soft terms or more whose weights add up to
``SOFT_WEIGHT``. A rule that fits the host and path goes before the vocabulary. The terms below are a small default; a real
vocabulary is a table, see :meth:`UrlFilter.of_table`.

Rules and vocabulary are parameters, sent once to each Python worker; together they may hold at most
``MAX_ENTRIES`` entries (checked), so what is shipped has a proven bound. Pages are judged in place: no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import texts_of

MAX_ENTRIES = 2_000_000
SOFT_HITS = 2
SOFT_WEIGHT = 2.0

#: Production vocabulary: whole words or hyphenated phrases of a URL.
STRICT_TERMS = ("porn", "xxx", "casino", "viagra", "escort", "hentai", "free-bets", "online-casino", "sex-cams", "cheap-pills")
SOFT_TERMS = ("adult", "bet", "bets", "betting", "poker", "sex", "pills", "cheap", "free", "win", "bonus", "dating",
              "nude", "cams", "slots", "loans")

#: Production rules ``(action, host, path prefix)``; a host covers its subdomains.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


@dataclass(frozen=True)
class UrlFilter:
    """``judge(url bytes or None) -> (host, path, rule, verdict, strict hits, soft hits)``.

    A soft term is a string (weight 1) or ``(term, weight)``; of a term named twice the greater weight counts.
    """

    rules: tuple = RULES
    strict: tuple = STRICT_TERMS
    soft: tuple = SOFT_TERMS
    soft_hits: int = SOFT_HITS
    soft_weight: float = SOFT_WEIGHT
    _built: dict = field(default_factory=dict, compare=False, repr=False)

    def __post_init__(self):
        n = len(self.rules) + len(self.strict) + len(self.soft)
        if n > MAX_ENTRIES:
            raise ValueError(f"{n} rules and terms; at most {MAX_ENTRIES} are sent to a worker")

    @classmethod
    def of_table(cls, vocabulary: DataFrame, version: str, rules: tuple = RULES, **limits) -> UrlFilter:
        """The filter of one ``version`` of ``vocabulary(version, term, kind, weight)``; ``kind`` is strict or soft.

        Null or empty terms and other kinds are left out, a null weight is 1. Its size is checked before it is fetched.
        """
        rows = vocabulary.where((F.col("version") == version) & (F.length("term") > 0) & F.col("kind").isin("strict", "soft"))
        held = rows.select("term", "kind", F.coalesce(F.col("weight").cast("double"), F.lit(1.0)).alias("weight")).limit(MAX_ENTRIES + 1).collect()
        if len(held) > MAX_ENTRIES:
            raise ValueError(f"version {version!r} has more than {MAX_ENTRIES} terms")
        return cls(rules, tuple(r["term"] for r in held if r["kind"] == "strict"),
                   tuple((r["term"], r["weight"]) for r in held if r["kind"] == "soft"), **limits)

    def __getstate__(self):
        return {**self.__dict__, "_built": {}}

    def _tables(self):
        if not self._built:
            hosts: dict = {}
            for action, host, path in self.rules:
                hosts.setdefault(host.encode(), []).append((path.encode(), action))
            for v in hosts.values():
                v.sort(key=lambda r: -len(r[0]))
            auto, weights = ahocorasick.Automaton(), {}
            for term, weight in ((x, 1.0) if isinstance(x, str) else x for x in self.soft):
                weights[term.lower()] = max(weight, weights.get(term.lower(), weight))
            for kind, terms in (("soft", weights), ("strict", self.strict)):
                for t in terms:
                    auto.add_word(t.lower(), (kind, t.lower()))
            auto.make_automaton()
            self._built.update(hosts=hosts, auto=auto, weights=weights)
        return self._built["hosts"], self._built["auto"]

    @staticmethod
    def split(url: bytes | None) -> tuple[bytes, bytes]:
        """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
        _, sep, rest = (url or b"").partition(b"://")
        if not sep:
            return b"", b""
        cut = min((i for i in map(rest.find, (b"/", b"?", b"#")) if i >= 0), default=len(rest))
        path = rest[cut:]
        end = min((i for i in map(path.find, (b"?", b"#")) if i >= 0), default=len(path))
        return rest[:cut].lower(), path[:end]

    def rule_for(self, host: bytes, path: bytes):
        """The longest fitting rule as ``(text, action)``, host and path length together; else None."""
        hosts, _ = self._tables()
        best, suffix = None, host
        while suffix:
            for p, action in hosts.get(suffix, ()):
                if path.startswith(p):
                    text = suffix + p
                    if best is None or len(text) > len(best[0]):
                        best = (text, action)
                    break
            suffix = suffix.partition(b".")[2]
        return best

    def hits(self, url: bytes | None) -> tuple[list, list]:
        """Distinct strict and soft terms that occur between boundaries."""
        _, auto = self._tables()
        found: dict = {"strict": set(), "soft": set()}
        text = (url or b"").decode("utf-8", "replace").lower()
        if len(auto):
            for end, (kind, term) in auto.iter(text):
                start = end - len(term) + 1
                if not _alnum(text, start - 1) and not _alnum(text, end + 1):
                    found[kind].add(term)
        return sorted(found["strict"]), sorted(found["soft"])

    def judge(self, url: bytes | None):
        host, path = self.split(url)
        rule = self.rule_for(host, path)
        strict, soft = self.hits(url)
        weight = sum(self._built["weights"][t] for t in soft)
        bad = bool(strict) or len(soft) >= self.soft_hits and weight >= self.soft_weight
        verdict = rule[1] if rule else ("block" if bad else "allow")
        return host, path, rule and rule[0], verdict, strict, soft


def _alnum(text: str, i: int) -> bool:
    return 0 <= i < len(text) and text[i].isascii() and text[i].isalnum()


_OUT = "host string, path string, rule string, verdict string, strict_hits array<string>, soft_hits array<string>"


def judge_urls(pages: DataFrame, url: str = "url", urls: UrlFilter | None = None) -> DataFrame:
    """``pages`` plus ``host``, ``path``, ``rule``, ``verdict``, ``strict_hits`` and ``soft_hits``.

    A null URL, or one without ``://``, has empty host and path and no rule; the vocabulary still sees
    its text. Rows are judged one by one, so repeated rows and ids agree. Columns of the added names are replaced.
    """
    f = urls or UrlFilter()

    @F.arrow_udf(_OUT)
    def run(col: pa.Array) -> pa.Array:
        cols = list(zip(*[f.judge(u) for u in texts_of(col)])) or [()] * 6
        kinds = [pa.binary()] * 3 + [pa.string()] + [pa.list_(pa.string())] * 2
        arrays = [pa.array(v, k) for v, k in zip(cols, kinds)]
        arrays[:3] = [a.cast(pa.string()) for a in arrays[:3]]
        return pa.StructArray.from_arrays(
            arrays, names=["host", "path", "rule", "verdict", "strict_hits", "soft_hits"])

    names = ["host", "path", "rule", "verdict", "strict_hits", "soft_hits"]
    return (pages.withColumn("__j", run(F.col(url).cast("string")))
            .withColumns({n: F.col(f"__j.{n}") for n in names}).drop("__j"))
