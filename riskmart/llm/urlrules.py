"""URL filter: a list of hosts and paths first, association rules of URL tokens for the rest.

The list's entries are host and path; one fits its host and all subdomains if the
path starts with its own, and the longest that fits decides.

Where none fits, mined rules decide:

1. Baskets: the tokens of a URL (words of scheme, host, path, query and fragment,
   marked by the part they stand in; digits become ``#``).
2. FP-growth over the baskets of bad pages finds token sets that at least
   ``MIN_SUPPORT`` of them hold (and ``MIN_COUNT`` pages).  Before that, tokens too
   rare for any set go, a token on every labelled page says nothing, and tokens that
   always stand in the same bad baskets are mined as one (closed sets), so that a URL
   repeated very often cannot blow up the search.  Where a basket holds more than
   ``WIDEST`` such tokens, whose sets FP-growth would list one by one, the sets are
   searched level by level instead (``free_sets``): every set that can be a rule, and
   none that has the pages of a smaller one.
3. A set's confidence is the share of bad pages among all labelled pages that hold
   it, as the lower end of its Wilson interval, so that a small set needs a
   clearer share.  Sets not above the share among all labelled pages go, and sets
   with a subset at least as sure.
4. Matching: a rule is posted under its rarest token; a basket meets only the rules
   posted under its own tokens and keeps those whose tokens it all holds.  Baskets
   are matched once, whatever the number of pages that share one.

A page's ``risk`` is its best rule's confidence (0 without any); from ``BLOCK`` on it
is blocked.

Cases: a null URL, or one without ``://``, has an empty host and path, no tokens and
is allowed; repeated rows are judged each; entries of equal length are told apart
by their text; without bad labels no rule is mined; an empty table gives no rows;
columns that are not named pass through ``judged`` untouched.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import stored, table

#: The list of the query, (verdict, host and path).
LIST = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Least share of the bad pages, and number of them, that hold a mined token set.
MIN_SUPPORT, MIN_COUNT = 0.002, 20
#: A page is blocked from this confidence on.
BLOCK = 0.5
#: Normal quantile of the confidence's interval.
Z = 1.96
#: Frequent tokens of one basket up to which FP-growth lists the sets; with a wider basket they are searched by ``free_sets``.
WIDEST = 16
#: Copies of a basket that one row stands for while they are dealt.
RUN = 1024

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: ASCII that is neither letter nor digit.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
URL = r"(?s)^(.*?)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def url_part(url: Column, k: int) -> Column:
    """Scheme, host, path, query, fragment (1 to 5), as written; empty where there is none."""
    return F.coalesce(F.regexp_extract(url, URL, k), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(url_part(url, 2), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return url_part(url, 3)


def tokens_of(url: Column) -> Column:
    """Sorted distinct tokens, such as ``h:example`` or ``p:#``."""
    def marked(mark: str, text: Column) -> Column:
        words = F.filter(F.split(F.translate(text, UPPER, LOWER), BETWEEN), lambda w: w != "")
        return F.transform(words, lambda w: F.concat(F.lit(mark + ":"), F.regexp_replace(w, "[0-9]+", "#")))
    parts = [marked(mark, url_part(url, k)) for k, mark in enumerate("shpqf", 1)]
    return F.array_sort(F.array_distinct(F.concat(*parts)))


def listed(host: Column, path: Column, entries=LIST) -> Column:
    """(rule, verdict) of the longest entry that fits, null where none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(entries, key=lambda x: (len(x[1]), x[1])):
        of, slash, below = rule.partition("/")
        fits = ((host == of) | F.endswith(host, F.lit("." + of))) & F.startswith(path, F.lit(slash + below))
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _sure(bad: Column, n: Column, z: float = Z) -> Column:
    """Lower end of the Wilson interval of ``bad / n``."""
    p = bad / n
    return (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def _matches(baskets: DataFrame, rules: DataFrame) -> DataFrame:
    """Every (basket, rule) whose tokens the basket holds, through the postings of the rules' rarest tokens; a rule's n as ``of``."""
    met = baskets.select("*", F.explode("tokens").alias("posting")).join(
        rules.drop("bad").withColumnRenamed("n", "of"), F.col("posting") == F.col("anchor"))
    return met.where(F.size(F.array_except("items", "tokens")) == 0).drop("posting")


def free_sets(held: DataFrame, least: float) -> DataFrame:
    """(mined) of the token sets that may be rules, from (id, n, bad, token) of all labelled baskets.

    A set grows by one token at a time, inside the baskets that hold it, while all its
    subsets of one token less are in the running.  Out of it go, with all that contain
    them, sets of too few bad pages; sets of the very pages of a subset; and sets whose
    bad pages, were there no others, would not make them surer than a subset: a
    rule that contains one of those is redundant."""
    place = held.select("id", "n", "bad", F.array().cast("array<string>").alias("head"), F.col("token").alias("last"))
    known = found = None
    while True:
        sets = place.groupBy("head", "last").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).where(F.col("bad") >= least)
        sets = sets.select(F.concat("head", F.array("last")).alias("mined"), "head", "last", "n", "bad",
                           _sure(F.col("bad"), F.col("n")).alias("own"), _sure(F.col("bad"), F.col("bad")).alias("most"))
        if known is None:
            sets = sets.withColumn("top", F.col("own"))
        else:
            below = F.transform("mined", lambda x, i: F.filter("mined", lambda _, j: i != j))
            subsets = sets.select("mined", F.col("n").alias("of"), F.col("bad").alias("of_bad"), F.explode(below).alias("subset")).join(
                known.select(F.col("mined").alias("subset"), "n", "bad", "top"), "subset")
            same = F.bool_or((F.col("n") == F.col("of")) & (F.col("bad") == F.col("of_bad")))
            tops = subsets.groupBy("mined").agg(F.count(F.lit(1)).alias("subsets"), same.alias("same"), F.max("top").alias("above"))
            sets = sets.join(tops.where(~F.col("same")), "mined").where(
                (F.col("subsets") == F.size("mined")) & (F.col("above") < F.col("most"))).withColumn("top", F.greatest("own", "above"))
        sets = stored(sets.select("mined", "head", "last", "n", "bad", "top", "most"), "url-level")
        found = sets.select("mined") if found is None else found.unionAll(sets.select("mined"))
        known = sets.where(F.col("top") < F.col("most"))
        if known.isEmpty():
            return found
        place = stored(place.join(known.select("head", "last"), ["head", "last"], "left_semi"), "url-places")
        more = place.select("id", "head", F.col("last").alias("next"))
        place = place.join(more, ["id", "head"]).where(F.col("last") < F.col("next")).select(
            "id", "n", "bad", F.concat("head", F.array("last")).alias("head"), F.col("next").alias("last"))


def mined(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_count: int = MIN_COUNT) -> DataFrame:
    """(items, n, bad, confidence, anchor) of the rules of ``labelled`` (tokens, bad boolean)."""
    spark = labelled.sparkSession
    counted = stored(labelled.groupBy("tokens").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("bad")), "url-baskets")
    n, bad = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    none = spark.createDataFrame([], "items array<string>, n long, bad long, confidence double, anchor string")
    if not bad:
        return none
    least = max(min_count, min_support * bad)
    # Tokens with the same count and the same sum of basket hashes stand in the same baskets.
    held = counted.select("tokens", "n", "bad", F.xxhash64("tokens").alias("id"), F.explode("tokens").alias("token"))
    mark = F.when(F.col("bad") > 0, F.col("id")).cast("decimal(38,0)")
    frequent = held.groupBy("token").agg(F.sum("n").alias("seen"), F.sum("bad").alias("held"), F.sum(mark).alias("where"))
    frequent = frequent.where((F.col("held") >= least) & (F.col("seen") < n))
    closed = stored(frequent.groupBy("held", "where").agg(F.min("token").alias("token"), F.collect_set("token").alias("all")),
                    "url-tokens")
    baskets = held.where("bad > 0").join(closed.select("token", "held"), "token").groupBy("tokens", "bad").agg(
        F.transform(F.array_sort(F.collect_list(F.struct((-F.col("held")).alias("o"), "token"))), lambda x: x["token"]).alias("items"))
    baskets = stored(baskets.select("items", "bad"), "url-bad")
    if (baskets.agg(F.max(F.size("items"))).first()[0] or 0) > WIDEST:
        # A basket holds what is mined as one if it holds all of it; a good one may hold a part.
        numbered = counted.withColumn("id", F.monotonically_increasing_id())  # before the tokens are spread
        every = numbered.select("id", "n", "bad", F.explode("tokens").alias("token")).join(
            closed.select(F.col("token").alias("one"), "all", F.explode("all").alias("token")), "token").groupBy("id", "n", "bad", "one").agg(
            (F.count(F.lit(1)) == F.first(F.size("all"))).alias("whole"))
        places = stored(every.where("whole").select("id", "n", "bad", F.col("one").alias("token")), "url-places")
        return _rules(counted, closed, free_sets(places, least), least, bad / n)
    # A basket as often as it is bad; one that is very often is dealt over the tasks in runs.
    runs = baskets.select("items", "bad", F.explode(F.sequence(F.lit(0), F.floor((F.col("bad") - 1) / RUN))).alias("run"))
    copies = runs.repartition("items", "run").select("items", F.explode(F.sequence(
        F.lit(1), F.least(F.lit(RUN).cast("long"), F.col("bad") - F.col("run") * RUN))))
    copies = stored(copies.select("items"), "url-mined")
    total = copies.count()
    if not total:
        return none
    sets = stored(FPGrowth(itemsCol="items", minSupport=min(1.0, least / total)).fit(copies).freqItemsets.select(
        F.col("items").alias("mined"), F.col("freq").cast("long").alias("freq")).where(F.col("freq") >= least), "url-sets")
    return _rules(counted, closed, sets, least, bad / n)


def _rules(counted: DataFrame, closed: DataFrame, sets: DataFrame, least: float, share: float) -> DataFrame:
    """The rules among the mined sets: counted, surer than ``share`` and than each of their subsets."""
    whole = sets.withColumn("id", F.monotonically_increasing_id())
    whole = stored(whole.select("id", F.explode("mined").alias("token")).join(closed, "token").groupBy("id").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("all")))).alias("items"),
        F.min_by("token", F.struct("held", "token")).alias("anchor")).drop("id"), "url-rules")
    # The confidence counts all labelled baskets, the good ones too.
    seen = _matches(counted, whole).groupBy("items", "anchor").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    rules = stored(seen.where(F.col("bad") >= least).withColumn("confidence", _sure(F.col("bad"), F.col("n")))
                   .where(F.col("confidence") > share).select("items", "n", "bad", "confidence", "anchor"), "url-rules")
    # A rule as a basket meets its subsets; one at least as sure makes it redundant.
    weaker = _matches(rules.select(F.col("items").alias("tokens"), F.col("confidence").alias("own")), rules).where(
        (F.size("items") < F.size("tokens")) & (F.col("confidence") >= F.col("own"))).select(F.col("tokens").alias("items")).distinct()
    return stored(rules.join(weaker, "items", "left_anti"), "url-rules")


def scored(baskets: DataFrame, rules: DataFrame) -> DataFrame:
    """(tokens, risk, mined_rule): the surest rule of every basket that meets one."""
    best = F.max_by(F.struct(F.col("confidence").alias("risk"), F.array_join("items", " ").alias("mined_rule")),
                    F.struct("confidence", "of", F.array_join("items", " ")))
    return _matches(baskets.select("tokens").distinct(), rules).groupBy("tokens").agg(best.alias("b")).select("tokens", "b.*")


def judged(pages: DataFrame, rules: DataFrame, entries=LIST, block: float = BLOCK) -> DataFrame:
    """``pages`` with host, path, rule, verdict, risk and mined_rule (columns of these names are replaced)."""
    added = ("host", "path", "rule", "verdict", "risk", "mined_rule")
    kept = [c for c in pages.columns if c not in added]
    rows = pages.select(F.struct(*[pages[c] for c in kept]).alias("page"), host_of(pages["url"]).alias("host"),
                        path_of(pages["url"]).alias("path"), tokens_of(pages["url"]).alias("tokens"))
    scores = scored(rows, rules).withColumnRenamed("tokens", "of")
    found = rows.join(scores, F.col("tokens") == F.col("of"), "left").withColumn("list", listed(F.col("host"), F.col("path"), entries))
    verdict = F.coalesce("list.verdict", F.when(F.col("risk") >= block, "block").otherwise("allow"))
    return found.select("page.*", "host", "path", F.col("list.rule").alias("rule"), verdict.alias("verdict"),
                        F.coalesce("risk", F.lit(0.0)).alias("risk"), "mined_rule")


def op13_urls(spark, sf_dir) -> DataFrame:
    """Every ``pages`` url.  A page is labelled through the document whose number stands last in its path; it
    counts as bad if that document is toxic or of quality 0."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    number = F.regexp_extract(path_of(F.col("url")), r"([0-9]+)[^0-9]*$", 1).try_cast("long")
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("number")).agg(
        F.coalesce(F.bool_or((F.col("toxic") == 1) | (F.col("quality") == 0)), F.lit(False)).alias("bad"))
    labelled = pages.select(tokens_of(F.col("url")).alias("tokens"), number.alias("number")).join(marks, "number").select("tokens", "bad")
    return judged(pages.select("page_id", "url"), mined(labelled)).select(
        "page_id", "host", "path", "rule", "verdict", "risk", "mined_rule")
