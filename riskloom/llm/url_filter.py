"""URL filters: a trie over reversed host labels and path segments, broadcast to the tasks.

A rule names a host, the start of a path and a verdict. It fits its host and all subdomains, if the URL's path
starts with the rule's. Of the rules that fit, the one with the longest host wins, then the one with the longest
path; of two rules for the same place `block` wins over `allow`. A rule with an empty host fits every host.

The trie goes down the labels of a host from the right. At each label rules hang as a second trie over the segments of
their path; what follows a path's last slash need only be the beginning of the URL's next segment. A lookup takes
steps only along nodes that exist, so its work is bounded by the deepest rule and not by the URL.

The trie goes to every task only up to RULE_BYTES of rules. Longer lists are joined instead, by host and by the path up to
a slash, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from riskloom.llm.names import fresh
from riskloom.session import run_dir

ALLOW, BLOCK = "allow", "block"
RULE_BYTES = 32 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class _Node:
    """A label or segment: what follows it, the rules that end here, and (for labels) their paths."""

    __slots__ = ("below", "ends", "paths")

    def __init__(self):
        self.below: dict[str, _Node] = {}
        self.ends: dict[str, tuple[str, str]] = {}
        self.paths: _Node | None = None


class Trie:
    """Rules by reversed host labels, then by path segments."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self._root = _Node()
        for host, path, verdict in rules:
            node = self._root
            for label in reversed(host.split(".") if host else []):
                node = node.below.setdefault(label, _Node())
            if node.paths is None:
                node.paths = _Node()
            node = node.paths
            *segments, rest = path.split("/")
            for segment in segments:
                node = node.below.setdefault(segment, _Node())
            if node.ends.get(rest, ("", ALLOW))[1] != BLOCK:
                node.ends[rest] = (host + path, verdict)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """The winning rule, as written, and its verdict."""
        best = None
        node, labels = self._root, iter(reversed(host.split(".")))
        while node is not None:
            if node.paths is not None:
                best = _longest(node.paths, path) or best
            label = next(labels, None)
            node = None if label is None else node.below.get(label)
        return best


def _longest(node: _Node, path: str) -> tuple[str, str] | None:
    best, at = None, 0
    while True:
        fitting = [rest for rest in node.ends if path.startswith(rest, at)]
        if fitting:
            best = node.ends[max(fitting, key=len)]
        slash = path.find("/", at)
        node = node.below.get(path[at:slash]) if slash >= 0 else None
        if node is None:
            return best
        at = slash + 1


def cut_urls(pages: DataFrame, url: str = "url") -> DataFrame:
    """The columns of pages with `host` and `path` of the URL.

    The host goes from behind the first `://` to `/`, `?`, `#` or the end, A-Z as a-z; the path from there to `?`, `#` or
    the end. Both are empty where the URL is NULL or has no `://`. Columns of these names are replaced.
    """
    text = F.col(url).cast("string")
    place = F.locate("://", text)
    rest = F.when(place > 0, F.substring(text, place + 3, F.length(text))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return pages.withColumns({"host": host, "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)})


def usable_rules(rules: DataFrame) -> DataFrame:
    """Distinct rules with A-Z of their host as a-z; NULL host or path is empty, other verdicts are refused."""
    host = F.translate(F.coalesce(F.col("host").cast("string"), F.lit("")), UPPER, LOWER)
    path = F.coalesce(F.col("path").cast("string"), F.lit(""))
    known = F.coalesce(F.col("verdict").isin(ALLOW, BLOCK), F.lit(False))
    verdict = F.when(known, F.col("verdict")).otherwise(F.raise_error(F.lit("a rule's verdict is allow or block")))
    return rules.select(host.alias("host"), path.alias("path"), verdict.alias("verdict")).distinct()


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = ALLOW, most: int = RULE_BYTES) -> DataFrame:
    """The columns of pages and `host`, `path`, `rule`, `verdict` of each row.

    `rules` has (host, path, verdict). `rule` is host and path of the winning rule, NULL if none fits, and then
    the verdict is `default`. Equal rows stay apart, an empty table gives no rows, and without rules every row has
    the default. A URL that is NULL or has no `://` has empty host and path, which only rules without a
    host fit. Columns of pages named like the new ones are replaced.
    """
    rules = usable_rules(rules)
    size = rules.agg(F.sum(F.octet_length("host") + F.octet_length("path") + 16)).first()[0] or 0
    cut = cut_urls(pages, url)
    if size > most:
        return _joined(cut, rules, default)
    shared = pages.sparkSession.sparkContext.broadcast(Trie([tuple(r) for r in rules.collect()]))  # at most `most` bytes

    (judged,) = fresh(cut, "judged")

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = shared.value
        for batch in batches:
            host, path = (batch.column(at).to_pylist() for at in places)
            found = [trie.find(h, p) for h, p in zip(host, path, strict=True)]
            kinds = pa.array([None if f is None else {"rule": f[0], "verdict": f[1]} for f in found], KIND)
            yield batch.append_column(judged, kinds)

    places = [[c.lower() for c in cut.columns].index(name) for name in ("host", "path")]
    schema = StructType([*cut.schema.fields, StructField(judged, StructType().add("rule", "string").add("verdict", "string"))])
    return _named(cut.mapInArrow(look_up, schema), judged, default)


KIND = pa.struct([("rule", pa.string()), ("verdict", pa.string())])


def _named(found: DataFrame, judged: str, default: str) -> DataFrame:
    rule, verdict = F.col(f"{judged}.rule"), F.coalesce(F.col(f"{judged}.verdict"), F.lit(default))
    return found.withColumns({"rule": rule, "verdict": verdict}).drop(judged)


def _joined(cut: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same for any number of rules: URLs by the ends of their host and by their path up to each slash.

    No more ends and slashes are tried than the deepest rule has. Distinct places are judged once.
    """
    place = run_dir(cut.sparkSession, "url-filter")
    labels = F.when(F.col("host") == "", 0).otherwise(F.size(F.split("host", r"\.")))
    base = F.regexp_extract("path", r"(?s)^(.*/)?", 0)
    rules = rules.select("host", base.alias("base"), "path", "verdict", labels.alias("labels"))
    rules.write.parquet(f"{place}/rules")
    rules = cut.sparkSession.read.parquet(f"{place}/rules")
    deepest, longest = rules.agg(F.max("labels"), F.max(F.length("base"))).first()
    places = cut.select(F.col("host").alias("h"), F.col("path").alias("p")).distinct()
    ends = F.expr(
        f"transform(sequence(0, least(size(split(h, '[.]')), {deepest})), n -> substring_index(h, '.', -n))"
    )
    heads = F.expr(
        f"transform(filter(sequence(0, least(length(p), {longest})), i -> i = 0 OR substring(p, i, 1) = '/'), i -> left(p, i))"
    )
    tried = places.withColumn("end", F.explode(F.array_distinct(ends))).withColumn("head", F.explode(heads))
    fits = (F.col("end") == F.col("host")) & (F.col("head") == F.col("base")) & F.startswith("p", "path")
    order = F.struct("labels", F.length("path"), (F.col("verdict") == BLOCK).alias("blocks"))
    h, p, judged = fresh(cut, "h", "p", "judged")
    best = F.max_by(F.struct(F.concat("host", "path").alias("rule"), "verdict"), order).alias(judged)
    best = tried.join(rules, fits).groupBy(F.col("h").alias(h), F.col("p").alias(p)).agg(best)
    found = cut.join(best, (F.col("host") == F.col(h)) & (F.col("path") == F.col(p)), "left").drop(h, p)
    return _named(found, judged, default)
