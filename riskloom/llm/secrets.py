"""Secret scans with multipart credential linking, with DataFrame functions only.

Plain kinds are reported wherever they stand. Weak parts (access identifiers, secret-like strings,
endpoints) say little alone; they are reported only where complementary parts stand within a scope:
an identifier and a secret that share no character, with at most SCOPE characters between them, and an endpoint
in reach of such a pair. The interval join goes along the borders of each text's parts in order, with the
nearest part of the other role that ended before or starts after, so it makes no pairs.

Places are found by marking what a pattern matches and counting the characters between the marks. The
mark is a private character; where a text has it already, another one of equal length stands in for it, which
no pattern tells apart. The counts are summed up within a row; a text with more than MANY parts between marks gives a row per
part instead, and running sums over these, so that the work grows in line with the matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.names import fresh

MARK, STAND_IN = "\ue000", "\ue001"
SCOPE = 200
ASSIGN = r"""((?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"(AKIA[A-Z0-9]{16,})"
HEX = r"([0-9a-f]{24,})"
IDENTIFIER = r"""(?i)((?:client|account|access_?key|key)_?id["']?\x20{0,4}[:=]\x20{0,4}["']?[A-Za-z0-9_.@-]{4,}|(?:user(?:name)?|login)["']?\x20{0,4}[:=]\x20{0,4}["']?[A-Za-z0-9_.@-]{3,})"""
# Digit, capital and small letter may stand anywhere in the match; a value may follow its "=" at once.
OPAQUE = r"((?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[a-z0-9+/_-]*[A-Z])(?=[A-Z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{16,}={0,2})"
ENDPOINT = r"((?i)(?:https?|jdbc:[a-z]{2,12}|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\x20\x09-\x0D\x22'<>]{4,})"
#: Kind, pattern, role in linking; plain kinds first, in the order ties are listed.
KINDS = (
    ("assign", ASSIGN, "secret"),
    ("access", ACCESS, "id"),
    ("hex", HEX, "secret"),
    ("identifier", IDENTIFIER, "id"),
    ("opaque", OPAQUE, "secret"),
    ("endpoint", ENDPOINT, "endpoint"),
)
PLAIN = 3
MANY = 512
CHUNK = 4096  # characters of a long text in which spans are replaced at once
SPANS = "array<struct<start:int,rank:int,stop:int>>"


def _step(number: int) -> int:
    """Parts a match adds. An assignment has a second mark before its value, whose length decides."""
    return 3 if KINDS[number][0] == "assign" else 2


def _lengths(text: Column, number: int) -> Column:
    """Lengths, in code points, of what stands between the marks of a kind's matches."""
    marked = f"{MARK}$1{MARK}$2{MARK}" if _step(number) == 3 else f"{MARK}$1{MARK}"
    return F.transform(F.split(F.regexp_replace(text, KINDS[number][1], marked), MARK), lambda part: F.length(part))


def _summed(lengths: Column, number: int) -> Column:
    """Array of (start, rank, stop) of a kind's matches, code points, stop exclusive; for few matches."""
    step = _step(number)

    def add(state: Column, length: Column) -> Column:
        turn, to = F.pmod(state["i"], F.lit(step)), state["at"] + length
        whole = (turn == step - 1) & (length >= 6 if step == 3 else F.lit(True))
        span = F.struct(state["from"].alias("start"), F.lit(number).alias("rank"), to.alias("stop"))
        return F.struct(
            to.alias("at"),
            (state["i"] + 1).alias("i"),
            F.when(turn == 0, to).otherwise(state["from"]).alias("from"),
            F.when(whole, F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out"),
        )

    none = F.array().cast(SPANS)
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("i"), F.lit(0).alias("from"), none.alias("out"))
    return F.when(F.size(lengths) > 1, F.aggregate(lengths, start, add, lambda s: s["out"])).otherwise(none)


def _spans_of_many(marked: DataFrame, row: str, kinds: list[str], plain: str, weak: str) -> DataFrame:
    """(row, plain, weak) of rows with many parts, from a row per part."""
    numbered = [F.struct(F.lit(n).alias("rank"), F.col(k).alias("lengths")) for n, k in enumerate(kinds)]
    parts = marked.select(F.col(row).alias("row"), F.explode(F.array(*numbered)).alias("k"))
    parts = parts.select("row", F.col("k.rank").alias("rank"), F.posexplode("k.lengths").alias("place", "length"))
    order = Window.partitionBy("row", "rank").orderBy("place")
    stop = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("int")
    parts = parts.withColumn("stop", stop).withColumn("begin", F.col("stop") - F.col("length"))
    parts = parts.withColumn("before", F.lag("begin").over(order))
    assign = F.lit([k[0] for k in KINDS].index("assign"))
    value = (F.col("rank") == assign) & (F.col("place") % 3 == 2) & (F.col("length") >= 6)
    found = parts.where(value | (F.col("rank") != assign) & (F.col("place") % 2 == 1))
    start = F.when(F.col("rank") == assign, F.col("before")).otherwise(F.col("begin"))
    span = F.struct(start.alias("start"), "rank", "stop")
    few = F.col("rank") < PLAIN
    both = [F.array_sort(F.collect_list(F.when(c, span))).alias(n) for c, n in ((few, plain), (~few, weak))]
    return found.groupBy(F.col("row").alias(row)).agg(*both)


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    shown = F.transform(
        F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"], s["stop"])
    )
    return F.array_join(shown, ",")


def secret_spans(docs: DataFrame, place: str, plain: str = "plain", weak: str = "weak", row: str = "row") -> DataFrame:
    """The columns of docs (doc_id, text, ...) but the text, with a row number and the spans found in each text.

    `plain` and `weak` are arrays of (start, rank, stop) with rank an index of KINDS; name them as no column of docs is
    named. A NULL text is empty, equal rows stay apart, an empty table gives no rows. `place` is a folder.
    """
    spark = docs.sparkSession
    text, *kinds = fresh(docs, "clean", *[f"k{n}" for n in range(len(KINDS))])
    marked = docs.withColumn(text, F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), MARK, STAND_IN))
    marked = marked.withColumns({k: _lengths(F.col(text), n) for n, k in enumerate(kinds)}).drop(text, "text")
    marked.withColumn(row, F.monotonically_increasing_id()).write.parquet(f"{place}/marked")
    marked = spark.read.parquet(f"{place}/marked")  # one reading of the texts, and fixed row numbers
    most = F.greatest(*[F.size(k) for k in kinds])
    few = marked.where(most <= MANY)
    few = few.withColumn(plain, F.array_sort(F.concat(*[_summed(F.col(k), n) for n, k in enumerate(kinds[:PLAIN])])))
    few = few.withColumn(weak, F.array_sort(F.concat(*[_summed(F.col(k), n + PLAIN) for n, k in enumerate(kinds[PLAIN:])])))
    many = marked.where(most > MANY)
    many = many.drop(*kinds).join(_spans_of_many(many.select(row, *kinds), row, kinds, plain, weak), row, "left")
    none = F.array().cast(SPANS)  # of parts too short for an assignment
    many = many.withColumns({c: F.coalesce(c, none) for c in (plain, weak)})
    found = few.drop(*kinds).unionByName(many)
    found.write.parquet(f"{place}/found")
    return spark.read.parquet(f"{place}/found")


def linked_spans(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(row, linked) for found (row, plain, weak): the weak parts that complementary parts stand near, as an array of spans.

    An identifier and a secret are two parts only if they share no character, and an opaque value within an
    identifier is that identifier's own. An endpoint counts if parts of such pairs, one of each role, stand near
    it or in it.
    """
    row = "row"
    roles = F.array(*[F.lit(k[2]) for k in KINDS])
    parts = found.where("size(weak) > 0").select(row, F.explode(F.concat("plain", "weak")).alias("s"))
    parts = parts.select(row, "s", F.element_at(roles, F.col("s.rank") + 1).alias("role"))

    upto = Window.partitionBy(row).orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    rank = {k[0]: n for n, k in enumerate(KINDS)}
    named = F.max(F.when(F.col("s.rank") == rank["identifier"], F.col("s.stop"))).over(upto)
    parts = parts.withColumn("own", (F.col("s.rank") == rank["opaque"]) & (F.coalesce(named, F.lit(0)) >= F.col("s.stop")))
    parts = parts.where("NOT own").drop("own")

    # Both borders of each part in order, ends first: what ended before a start, what starts after an end.
    border = F.array(
        F.struct(F.col("s.start").alias("at"), F.lit(True).alias("opens")),
        F.struct(F.col("s.stop").alias("at"), F.lit(False).alias("opens")),
    )
    borders = parts.where("role <> 'endpoint'").withColumn("e", F.explode(border))
    opens, at = F.col("e.opens"), F.col("e.at")
    back = Window.partitionBy(row).orderBy("e").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy(row).orderBy(F.desc("e")).rowsBetween(Window.unboundedPreceding, -1)

    def apart(role: str) -> Column:
        before = at - F.max(F.when(~opens & (F.col("role") == role), at)).over(back)
        after = F.min(F.when(opens & (F.col("role") == role), at)).over(ahead) - at
        return F.coalesce(F.when(opens, before).otherwise(after), F.lit(scope + 1)) <= scope

    borders = borders.withColumn("by_id", apart("id")).withColumn("by_secret", apart("secret"))
    paired = (F.col("role") == "id") & F.col("by_secret") | (F.col("role") == "secret") & F.col("by_id")
    paired = borders.where(paired).select(row, "s", "role").distinct()

    reach = paired.unionByName(parts.where("role = 'endpoint'"))
    ahead = Window.partitionBy(row).orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, -1)

    def near(role: str) -> Column:
        other = F.when(F.col("role") == role, F.col("s"))
        before = F.col("s.start") - F.max(other["stop"]).over(upto)
        after = F.min(other["start"]).over(ahead) - F.col("s.stop")
        return (F.coalesce(before, F.lit(scope + 1)) <= scope) | (F.coalesce(after, F.lit(scope + 1)) <= scope)

    reach = reach.withColumn("by_id", near("id")).withColumn("by_secret", near("secret"))
    kept = reach.where((F.col("s.rank") >= PLAIN) & ((F.col("role") != "endpoint") | F.col("by_id") & F.col("by_secret")))
    return kept.groupBy(row).agg(F.array_sort(F.collect_list("s")).alias("linked"))


def secret_scan(docs: DataFrame, place: str, scope: int = SCOPE) -> DataFrame:
    """Per row of docs: its columns but the text, n_assign, n_access, n_hex, base_sha256, spans.

    `spans` are the plain and the linked parts as kind:start:stop in order of start, then of kind. Columns of docs named like
    these are replaced.
    """
    row, plain, weak, linked = fresh(docs, "row", "plain", "weak", "linked")
    found = secret_spans(docs, place, plain, weak, row)
    named = found.select(F.col(row).alias("row"), F.col(plain).alias("plain"), F.col(weak).alias("weak"))
    links = linked_spans(named, scope).select(F.col("row").alias(row), F.col("linked").alias(linked))
    none = F.array().cast(SPANS)
    counts = {f"n_{KINDS[n][0]}": F.expr(f"size(filter(`{plain}`, s -> s.rank = {n}))").cast("long") for n in range(PLAIN)}
    told = {
        **counts,
        "base_sha256": F.sha2(_joined(F.col(plain)), 256),
        "spans": _joined(F.concat(plain, F.coalesce(linked, none))),
    }
    return found.join(links, row, "left").withColumns(told).drop(row, plain, weak, linked)


def redacted(docs: DataFrame, place: str, replacement: str = "[secret]") -> DataFrame:
    """All rows of docs with each span found replaced; spans that overlap count as one.

    `n_chars` follows the new text. Texts without spans stay as they are, NULL included.
    """
    spark = docs.sparkSession
    row, spans, new = fresh(docs, "row", "spans", "new")
    docs.withColumn(row, F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(f"{place}/docs")
    kept = spark.read.parquet(f"{place}/docs")
    texts = kept.select(F.col(row).alias("of"), "text")
    found = secret_spans(texts, place)
    none = F.array().cast(SPANS)
    every = F.array_sort(F.concat("plain", F.coalesce("linked", none)))
    found = found.join(linked_spans(found), "row", "left").select("of", every.alias("spans")).where("size(spans) > 0")
    found.write.parquet(f"{place}/spans")
    found = spark.read.parquet(f"{place}/spans")

    piece = "substring(text, s.at + 1, greatest(x.start - s.at, 0))"
    # From left to right: the text since the last span, then the replacement, once for spans that overlap.
    replaced = (
        "aggregate({spans}, named_struct('at', 0, 'out', ''), (s, x) -> named_struct('at', greatest(s.at, x.stop), 'out', "
        f"CASE WHEN x.start < s.at THEN s.out ELSE concat(s.out, {piece}, '{replacement}') END), "
        "s -> concat(s.out, substring(text, s.at + 1)))"
    )
    few = found.where(F.size("spans") <= MANY).withColumn("new", F.lit(None).cast("string"))
    many = found.where(F.size("spans") > MANY)
    many = _replaced_in_chunks(texts.join(many, "of"), replacement).withColumn("spans", none)
    changes = few.unionByName(many).select(F.col("of").alias(row), F.col("spans").alias(spans), F.col("new").alias(new))
    joined = kept.join(changes, row, "left")
    short = F.expr(replaced.format(spans=f"`{spans}`"))
    text = F.when(F.col(spans).isNull(), F.col("text")).otherwise(F.coalesce(F.col(new), short))
    joined = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        changed = F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))
        joined = joined.withColumn("n_chars", changed)
    return joined.select(*docs.columns)


def _replaced_in_chunks(rows: DataFrame, replacement: str) -> DataFrame:
    """(of, new) for rows (of, text, spans): the same by chunks of the text, each with the spans in it."""
    chunks = rows.select("of", F.posexplode(F.regexp_extract_all("text", F.lit(f"(?s)(.{{1,{CHUNK}}})"), F.lit(1))).alias("chunk", "part"))
    cuts = rows.select("of", F.posexplode("spans").alias("place", "s"))
    before = Window.partitionBy("of").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    cuts = cuts.withColumn("to", F.coalesce(F.max("s.stop").over(before), F.lit(0)))
    opens = F.col("s.start") >= F.col("to")
    cuts = cuts.select("of", F.greatest("to", "s.start").alias("begin"), F.col("s.stop").alias("stop"), opens.alias("opens"))
    cuts = cuts.where("stop > begin")
    cuts = cuts.withColumn("chunk", F.explode(F.expr(f"sequence(begin div {CHUNK}, (stop - 1) div {CHUNK})")))
    at, first = F.col("chunk") * CHUNK, F.col("begin") >= F.col("chunk") * CHUNK
    local = F.struct(
        F.greatest(F.col("begin") - at, F.lit(0)).alias("start"),
        F.least(F.col("stop") - at, F.lit(CHUNK)).alias("stop"),
        (F.col("opens") & first).alias("opens"),
    )
    cuts = cuts.groupBy("of", "chunk").agg(F.array_sort(F.collect_list(local)).alias("cuts"))  # no more than a chunk has characters
    shown = F.expr(
        "aggregate(cuts, named_struct('at', 0, 'out', ''), (s, x) -> named_struct('at', int(x.stop), 'out', "
        f"concat(s.out, substring(part, s.at + 1, int(x.start) - s.at), if(x.opens, '{replacement}', ''))), "
        "s -> concat(s.out, substring(part, s.at + 1)))"
    )
    parts = chunks.join(cuts, ["of", "chunk"], "left")
    parts = parts.select("of", F.struct("chunk", F.when(F.col("cuts").isNull(), F.col("part")).otherwise(shown).alias("part")).alias("p"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["part"]), "")
    return parts.groupBy("of").agg(whole.alias("new"))
