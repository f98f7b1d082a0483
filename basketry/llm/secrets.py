"""Secret scanning with corpus-wide ownership frequency.

Patterns propose candidates in every whole text. A candidate's value is kept as
its hash only. Hashes are counted over the corpus by distinct repositories and
owners, and both counts decide: a value that several owners or many repositories
have is a copied example, and so is a placeholder. A value that looks random, of one
owner at most and few repositories, is taken for live. Nulls are unknown: they
are no owner and no repository.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm import common
from basketry.llm.storage import cut

#: Kinds in their order; fixed patterns. A match counts if its value has enough characters.
KINDS = ("assign", "access", "hex", "live", "example")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run of digits and a-f is one match, so short runs need no match to be dropped
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Parts of values that nobody would use as a secret.
PLACEHOLDERS = re.compile(r"example|sample|dummy|change_?me|placeholder|your|xxxx|test|1234567|abcdef", re.IGNORECASE)
#: From so many owners or so many repositories on, a value is an example.
MANY_OWNERS, MANY_REPOSITORIES = 2, 8
LEAST_BITS = 2.5

Span = tuple[str, int, int, int, int, str, bool]


def bits(value: str) -> float:
    """Shannon entropy of the characters."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def looks_random(value: str) -> bool:
    return bits(value) >= LEAST_BITS and not PLACEHOLDERS.search(value)


def candidates(text: str) -> list[Span]:
    """Kind, start, end, value's start and end, value's hash, looks random; in code points, end exclusive."""
    found = []
    low = text.lower()
    if any(word in low for word in ASSIGN_WORDS):
        found += [("assign", m.start(), m.end(), *m.span(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [("access", *m.span(), *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [("hex", *m.span(), *m.span()) for m in HEX.finditer(text)]
    found.sort(key=lambda f: (f[1], KINDS.index(f[0])))
    values = ((f, text[f[3] : f[4]]) for f in found)
    return [(*f, hashlib.sha256(v.encode()).hexdigest(), looks_random(v)) for f, v in values]


_FOUND = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            *(T.StructField(n, T.IntegerType()) for n in ("start", "end", "value_start", "value_end")),
            T.StructField("hash", T.StringType()),
            T.StructField("random", T.BooleanType()),
        ]
    )
)
_NAMES = [f.name for f in _FOUND.elementType.fields]


def scan(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``candidates``: array of kind, start, end, value_start, value_end, hash, random.

    Ordered by start, then kind. A null or empty text has none. A value may be in
    several candidates of different kinds.
    """

    def make():
        def run(texts: common.Texts) -> list:
            return [[[dict(zip(_NAMES, f, strict=True)) for f in candidates(t)] for t in texts.strings()]]

        return run

    return common.with_text_columns(df, text, [("candidates", _FOUND)], make, keep)


def ownership(found: DataFrame, owner: str, repository: str) -> DataFrame:
    """Of each hash in ``candidates``: ``n_owners``, ``n_repositories`` and ``n_uses`` (longs).

    Null owners and repositories are not counted, their uses are. Uses are
    summed per (hash, owner, repository) before each shuffle, so a value that a
    third of all rows hold arrives as one row from each task.
    """
    uses = found.select(F.col(owner).alias("o"), F.col(repository).alias("r"), F.explode("candidates.hash").alias("hash"))
    each = uses.groupBy("hash", "o", "r").agg(F.count("*").alias("n"))
    owners = each.groupBy("hash", "o").agg(F.count("*").alias("n_r"), F.sum("n").alias("n"))
    by_owner = owners.groupBy("hash").agg(F.count("o").alias("n_owners"), F.sum("n").alias("n_uses"))
    by_repository = each.groupBy("hash", "r").count().groupBy("hash").agg(F.count("r").alias("n_repositories"))
    return by_owner.join(by_repository, "hash")


def with_counts(each: DataFrame, counts: DataFrame) -> DataFrame:
    """Candidates with the counts of their hashes.

    One more key gives the counts an exchange of their own, so that adaptive
    execution can split the rows of a hash that very many have.
    """
    spread = F.xxhash64("hash")
    return each.withColumn("__spread", spread).join(counts.withColumn("__spread", spread), ["hash", "__spread"]).drop("__spread")


def verdict_kind():
    """Column: ``live`` or ``example``, for every pair of counts."""
    copied = (F.col("n_owners") >= MANY_OWNERS) | (F.col("n_repositories") >= MANY_REPOSITORIES)
    return F.when(~copied & F.col("random"), "live").otherwise("example")


def find(
    df: DataFrame, text: str = "text", owner: str = "source", repository: str = "doc_id", keep: list[str] | None = None
) -> DataFrame:
    """``candidates`` of every row and the ``verdicts`` on them.

    ``verdicts`` is an array of ``kind`` (``live`` or ``example``), ``start``,
    ``end``, ``n_owners`` and ``n_repositories`` over the value's characters: one
    for each different value and place of the candidates. Columns ``keep`` (default:
    all but the text) stay. The candidates, without texts, are written to the shared
    folder before they are counted. Repeated rows are uses of the same owner.
    """
    kept = [c for c in (df.columns if keep is None else keep) if c != text or keep is not None]
    kept = [c for c in kept if c.lower() not in {"candidates", "verdicts", "__row", "__owner", "__repository"}]
    source = df.select(
        *[F.col(f"`{c}`") for c in kept],
        F.col(owner).alias("__owner"),
        F.col(repository).alias("__repository"),
        F.col(f"`{text}`").alias("__scanned"),
    )
    found = scan(source, "__scanned", [*kept, "__owner", "__repository"])
    found = cut(found.withColumn("__row", F.monotonically_increasing_id()))
    counts = ownership(found, "__owner", "__repository")
    each = with_counts(found.select("__row", F.explode("candidates").alias("c")).select("__row", "c.*"), counts)
    verdict = F.struct(verdict_kind().alias("kind"), F.col("value_start").alias("start"), F.col("value_end").alias("end"), "n_owners", "n_repositories")
    judged = each.groupBy("__row").agg(F.collect_set(verdict).alias("v"))
    order = F.array_sort("v", lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).when(a["end"] < b["end"], -1).when(a["end"] > b["end"], 1).otherwise(0))
    empty = F.array().cast("array<struct<kind:string,start:int,end:int,n_owners:bigint,n_repositories:bigint>>")
    return found.join(judged, "__row", "left").select(
        *[F.col(f"`{c}`") for c in kept], "candidates", F.coalesce(order, empty).alias("verdicts")
    )


def digest(spans):
    """Column: ``kind:start:end`` of an array of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def merged(base, more):
    """Column: spans of both arrays by start, then kind in the order of ``KINDS``, then end."""
    place = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    plain = lambda s: F.struct(s["start"].alias("start"), place[s["kind"]].alias("place"), s["end"].alias("end"), s["kind"].alias("kind"))
    return F.array_sort(F.concat(F.transform(base, plain), F.transform(more, plain)))
