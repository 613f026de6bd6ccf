"""Personal data: fixed patterns, and identifiers that their context gives away.

The base finds e-mail addresses, IP addresses, card and phone numbers by expression and arithmetic; what fails its test is
dropped. They are the seeds of a bootstrap. A lexical pattern is the two words before an identifier, or the word before and
the word after. Patterns and instances (other tokens that look like identifiers: with a digit or an at sign) make a
bipartite graph, counted once over all texts. Then, in ROUNDS rounds, a pattern belongs to the kind that most of its seeds
and known instances have, and scores the weighted share of these among all that are decided; instances not decided yet
count UNDECIDED of their weight against it. Patterns with enough seeds and known instances and a high
score vouch for the other instances they extract (noisy-or). Instances above the bar are known in the next round, in which they
count like seeds, so that patterns without any seed come in. In the end an occurrence in the context of a confident pattern
whose instance is known becomes a span of kind `context_<kind>`. Base spans and their counts stay as they are.

Everything is DataFrame expressions. Start points come from the lengths of what lies between matches, added up within
a document. The expressions are possessive and begin only where a match can, so they take linear time on any text. A
frequent pattern or instance is one row of the graph with a count.

Null and empty texts have no spans. Rows that repeat id and text give equal rows; other texts under the same id are
documents of their own. Null ids are kept. An empty table gives no rows. Further columns are not read. Two patterns that
claim one occurrence for different kinds give it to the first kind as listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innledger.session import new_folder

KINDS = ["email", "ip", "card", "phone"]
LOCAL = "[A-Za-z0-9._%+-]"
#: Where a match of an expression can begin follows from what it may not follow; \\G lets it follow the last match.
PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A character without which a text has no match.
NEEDED = {"email": "@", "ip": ".", "card": "", "phone": "+"}
#: A word with a digit or an at sign, without brackets and punctuation around it.
TOKEN = r"(?<!\S)(?=\S*[0-9@])\S++"
#: Code points of context that are looked at on each side.
CONTEXT = 80
#: Seeds and known instances a pattern has at least; scores of patterns that vouch and of instances that are known; what an
#: undecided instance weighs against a pattern, of one that contradicts it.
ROUNDS, FEWEST_SEEDS, PATTERN_SCORE, INSTANCE_SCORE, UNDECIDED = 3, 5, 0.5, 0.8, 0.05
FEWEST_CHARACTERS = 6
DOC = ["doc_id", "_text"]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit is right; leading zeros change nothing."""
    padded = F.lpad(digits, 20, "0")
    total = F.lit(0)
    for i in range(20):
        digit = F.substring(padded, i + 1, 1).cast("int")
        double = digit * 2
        total = total + (digit if i % 2 else F.when(double > 9, double - 9).otherwise(double))
    return total % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    small = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
    count = F.length(_digits(value))
    return (
        F.when(kind == "ip", value.rlike(rf"^{small}(?:\.{small}){{3}}$"))
        .when(kind == "card", F.when(count.between(16, 19), _luhn(_digits(value))).otherwise(False))
        .when(kind == "phone", count.between(8, 15))
        .otherwise(True)
    )


def _matches(documents: DataFrame, kind: str, pattern: str) -> DataFrame:
    """Every match with its place and context; `start` in code points, `end` exclusive."""
    needed = NEEDED.get(kind, "")
    some = documents.where(F.col("text").contains(needed)) if needed else documents
    gaps = F.split("text", pattern, -1)
    found = some.select("_row", *DOC, gaps.alias("gaps"), F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("values"))
    found = found.where(F.size("values") > 0)
    # Two words on a side lie in three gaps and the two matches between them, whatever these are.
    tail = lambda x: F.right(x, F.lit(CONTEXT))
    head = lambda x: F.left(x, F.lit(CONTEXT))
    found = found.withColumns(
        {
            "tails": F.transform("gaps", tail), "heads": F.transform("gaps", head),
            "value_tails": F.transform("values", tail), "value_heads": F.transform("values", head),
        }
    )

    def before(value: Column, i: Column) -> Column:
        parts = [("tails", -2), ("value_tails", -2), ("tails", -1), ("value_tails", -1), ("tails", 0)]
        return tail(F.concat_ws("", *[F.get(name, i + step) for name, step in parts]))

    def after(value: Column, i: Column) -> Column:
        parts = [("heads", 1), ("value_heads", 1), ("heads", 2), ("value_heads", 2), ("heads", 3)]
        return head(F.concat_ws("", *[F.get(name, i + step) for name, step in parts]))

    pieces = F.arrays_zip(
        F.transform("gaps", F.length).alias("gap"),
        "values",
        F.transform("values", before).alias("before"),
        F.transform("values", after).alias("after"),
    )
    rows = found.select("_row", *DOC, F.posexplode(pieces).alias("i", "p")).where("p.values is not null")
    length = F.length("p.values")
    end = F.sum(F.col("p.gap") + length).over(Window.partitionBy("_row").orderBy("i"))
    return rows.select(
        *DOC,
        F.lit(kind).alias("kind"),
        (end - length).alias("start"),
        end.alias("end"),
        F.col("p.values").alias("value"),
        F.col("p.before").alias("before"),
        F.col("p.after").alias("after"),
    )


def _word(context: Column, expression: str) -> Column:
    return F.lower(F.regexp_extract(context, expression, 1))


def _patterns() -> Column:
    """The lexical patterns of an occurrence; one without the words for a pattern has none of that form."""
    two = _word(F.col("before"), r"(\S+\s+\S+)\s*$")
    left, right = _word(F.col("before"), r"(\S+)\s*$"), _word(F.col("after"), r"^\s*(\S+)")
    around = F.when((left != "") & (right != ""), F.concat(F.lit("around:"), left, F.lit(" _ "), right))
    after = F.when(two != "", F.concat(F.lit("after:"), F.regexp_replace(two, r"\s+", " ")))
    return F.array_compact(F.array(after, around))


def _outside(tokens: DataFrame, base: DataFrame) -> DataFrame:
    """The tokens that overlap no base span."""
    spans = base.select(*DOC, "start", "end", F.lit(True).alias("is_base"))
    both = tokens.withColumn("is_base", F.lit(False)).unionByName(spans, allowMissingColumns=True)
    order = Window.partitionBy(*DOC).orderBy("start", F.col("is_base").desc())
    earlier = F.max(F.when(F.col("is_base"), F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    back = Window.partitionBy(*DOC).orderBy(F.col("start").desc(), "is_base")
    later = F.min(F.when(F.col("is_base"), F.col("start"))).over(back.rowsBetween(Window.unboundedPreceding, -1))
    marked = both.withColumn("_earlier", earlier).withColumn("_later", later).where("not is_base")
    free = F.coalesce(F.col("_earlier") <= F.col("start"), F.lit(True)) & F.coalesce(
        F.col("_later") >= F.col("end"), F.lit(True)
    )
    return marked.where(free).drop("is_base", "_earlier", "_later")


def discover(base: DataFrame, tokens: DataFrame, folder: str) -> DataFrame:
    """Occurrences among the tokens that confident patterns give away: DOC, kind, start, end."""
    spark = base.sparkSession

    def kept(frame: DataFrame, name: str) -> DataFrame:
        frame.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{folder}/{name}")

    def edges(rows: DataFrame) -> DataFrame:
        instance = F.lower("value").alias("instance")
        return rows.select("kind", instance, F.explode(_patterns()).alias("pattern")).groupBy("pattern", "kind", "instance").count()

    # Seeds have their kind, other instances none yet.
    graph = kept(edges(base.where("kind <> 'token'")).unionByName(edges(tokens)), "graph")
    # A pattern with fewer instances in all can never have enough that are known.
    enough = graph.groupBy("pattern").agg(F.count_distinct("instance").alias("all")).where(F.col("all") >= FEWEST_SEEDS)
    graph = kept(graph.join(enough.select("pattern"), "pattern"), "candidates")
    known = spark.createDataFrame([], "instance string, as_kind string, score double")
    for n in range(ROUNDS):
        told = graph.join(known, "instance", "left")
        is_seed = F.col("kind") != "token"
        judged = told.select(
            "pattern",
            F.when(is_seed, F.col("kind")).otherwise(F.col("as_kind")).alias("label"),
            (F.log1p("count") * F.when(is_seed, 1.0).otherwise(F.coalesce("score", F.lit(UNDECIDED)))).alias("weight"),
        )
        per_label = judged.groupBy("pattern", "label").agg(F.sum("weight").alias("weight"), F.count("*").alias("n"))
        lead = F.max(F.when(F.col("label").isNotNull(), F.struct("weight", "label", "n"))).alias("lead")
        scored = per_label.groupBy("pattern").agg(lead, F.sum("weight").alias("total")).where("lead.n >= 1")
        patterns = scored.select(
            "pattern", F.col("lead.label").alias("own"), F.col("lead.n").alias("n"), (F.col("lead.weight") / F.col("total")).alias("p")
        )
        patterns = kept(
            patterns.where((F.col("n") >= FEWEST_SEEDS) & (F.col("p") >= PATTERN_SCORE)).select("pattern", "own", "p"),
            f"patterns{n}",
        )
        votes = graph.where("kind = 'token'").join(patterns, "pattern")
        belief = votes.groupBy("instance", F.col("own").alias("as_kind")).agg(
            (1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("p"), F.lit(1e-6)))))).alias("score")
        )
        best = belief.where(F.col("score") >= INSTANCE_SCORE).groupBy("instance").agg(
            F.max_by(F.struct("as_kind", "score"), F.struct("score", "as_kind")).alias("b")
        )
        known = kept(best.select("instance", "b.as_kind", "b.score"), f"known{n}")
    last = spark.read.schema(patterns.schema).parquet(f"{folder}/patterns{ROUNDS - 1}").select("pattern", "own")
    places = tokens.select(*DOC, "start", "end", F.lower("value").alias("instance"), F.explode(_patterns()).alias("pattern"))
    sure = places.join(last, "pattern").join(known, "instance").where("own = as_kind")
    order = F.min(F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("own"))).alias("k")
    one = sure.groupBy(*DOC, "start", "end").agg(order)
    kind = F.concat(F.lit("context_"), F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("k").cast("int")))
    return one.select(*DOC, kind.alias("kind"), "start", "end")


def personal_data(documents: DataFrame) -> DataFrame:
    """doc_id, number of base spans of each kind, the hash of all base spans, all spans with the discovered ones last, and
    how many were discovered."""
    spark = documents.sparkSession
    folder = new_folder(spark, "pii")
    documents = documents.select("doc_id", "text", F.xxhash64("text").alias("_text"))
    # Nothing is found without a digit or an at sign; equal rows need one look.
    some = documents.where(F.col("text").rlike("[0-9@]")).withColumn("_row", F.monotonically_increasing_id())
    rows = _matches(some, "token", TOKEN)
    for kind in KINDS:
        rows = rows.unionByName(_matches(some, kind, PATTERNS[kind]).where(_valid(F.col("kind"), F.col("value"))))
    rows.dropDuplicates([*DOC, "kind", "start"]).write.partitionBy("kind").parquet(f"{folder}/found")
    found = spark.read.schema(rows.schema).parquet(f"{folder}/found")
    base = found.where(F.col("kind") != "token")

    # The token proper, without what may surround it.
    lead = F.length("value") - F.length(F.regexp_replace("value", r"^[\p{Punct}&&[^+@]]+", ""))
    bare = F.regexp_replace(F.regexp_replace("value", r"^[\p{Punct}&&[^+@]]+", ""), r"\p{Punct}+$", "")
    tokens = found.where(F.col("kind") == "token").select(
        *DOC, "kind", (F.col("start") + lead).alias("start"), bare.alias("value"), "before", "after"
    )
    enough = (F.length("value") >= FEWEST_CHARACTERS) & F.col("value").rlike("[0-9@]")
    tokens = tokens.where(enough).withColumn("end", F.col("start") + F.length("value"))
    tokens = _outside(tokens, base)
    tokens.write.parquet(f"{folder}/tokens")
    tokens = spark.read.schema(tokens.schema).parquet(f"{folder}/tokens")

    new = discover(base, tokens, folder)
    order = F.array_position(F.array(*[F.lit(k) for k in [*KINDS, *[f"context_{k}" for k in KINDS]]]), F.col("kind"))
    spans = base.select(*DOC, "kind", "start", "end").unionByName(new).withColumn("k", order)
    text = F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("end").cast("string"))
    listed = spans.groupBy(*DOC).agg(
        F.array_sort(F.collect_list(F.struct("k", "start", text.alias("s")))).alias("all"),
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in KINDS],
        F.count_if(F.col("kind").startswith("context_")).alias("n_context"),
    )
    only_base = F.filter("all", lambda x: x["k"] <= len(KINDS))
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: x["s"]), ",")
    listed = listed.select(
        F.col("doc_id").alias("_id"), F.col("_text").alias("_hash"), *[f"n_{k}" for k in KINDS], "n_context",
        F.sha2(joined(only_base), 256).alias("base_sha256"), joined(F.col("all")).alias("spans"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("_text").eqNullSafe(F.col("_hash"))
    return documents.select(*DOC).join(listed, same, "left").select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in KINDS],
        F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
        F.coalesce("n_context", F.lit(0).cast("long")).alias("n_context"),
    )
