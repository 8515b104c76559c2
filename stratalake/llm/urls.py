"""URL filter: rules for hosts and paths, and for the rest naive Bayes over segmented words.

Host names run words together. A unigram model of the words in the pages' own texts splits them by Viterbi search, and
a multinomial naive Bayes model over host and path words says whether a url looks like those that hold a word of a
given list. Both models are tables of counts over all rows, of any number of words: a run of letters meets the words that
it can be made of in a join on its substrings, and a url the odds of its words in a join on them.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.operators.joins import attach

from .common import stored

#: Substrings up to this length are joined as they are; longer words are found by their first letters, so many of them.
PREFIX = 32
#: Tokens that each class is given beforehand, spread like all tokens: a rare token then says little about either class.
SMOOTHING = 10.0
#: Words that mark a url to learn from as one to block; the tables hold no other sign of it.
BLOCK_WORDS = (
    "adult", "ads", "bet", "bets", "betting", "casino", "cheap", "free", "gambling", "jackpot", "loan", "lottery", "malware", "pills",
    "poker", "porn", "sex", "spam", "track", "viagra", "warez", "win", "xxx")
#: (verdict, host, path): a rule fits its host and all subdomains if the url's path starts with the rule's.
RULES = (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"),
    ("block", "net", "/fr/"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: str) -> Column:
    """Host of a url column with A-Z lower-cased; empty where the url is null or holds no ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: str) -> Column:
    """Path of a url column; empty where the url is null or holds no ``://``."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_and_verdict(host: str, path: str, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as host and path in one string, and its verdict; null where none fits."""
    rule = verdict = F.lit(None).cast("string")
    for action, name, start in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):  # the last to match stays
        fits = ((F.col(host) == name) | F.col(host).endswith("." + name)) & F.col(path).startswith(start)
        rule = F.when(fits, F.lit(name + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def unigrams(pages: DataFrame, html: str = "html") -> DataFrame:
    """Rows (word, n): the a-z words in the pages' visible text and how often each occurs; every word of every row."""
    text = F.lower(F.regexp_replace(F.coalesce(F.col(html), F.lit("")), r"(?is)<(script|style)\b.*?</\1>|<[^>]*>", " "))
    words = pages.select(F.explode(F.split(text, "[^a-z]+")).alias("word")).where("word != ''")
    return words.groupBy("word").agg(F.count("*").alias("n"))


class Segmenter:
    """Splits runs of letters into the most probable words of a unigram model of ``total`` words."""

    def __init__(self, total: int):
        self.total = math.log(total + 1)
        self.unknown = self.total + math.log(10)  # of one letter that no word covers

    def words(self, run: str, counts: dict[str, int]) -> list[str]:
        """``counts``: the words of the model that occur in the run."""
        cost = {w: self.total - math.log(n) for w, n in counts.items()}
        lengths = sorted({len(w) for w in cost})
        best, back = [0.0], [(0, False)]
        for end in range(1, len(run) + 1):
            options = [(best[end - 1] + self.unknown, end - 1, False)]
            for n in lengths:
                if n > end:
                    break
                own = cost.get(run[end - n:end])
                if own is not None:
                    options.append((best[end - n] + own, end - n, True))
            least, begin, known = min(options)
            best.append(least)
            back.append((begin, known))
        out, end, open_run = [], len(run), False
        while end:
            begin, known = back[end]
            if known or not open_run:
                out.append(run[begin:end])
            else:  # letters without a word stay together
                out[-1] = run[begin:end] + out[-1]
            open_run, end = not known, begin
        return out[::-1]


def segmented(runs: DataFrame, model: DataFrame, extra=()) -> DataFrame:
    """Rows (run, words) for different runs of letters, split by a stored ``model`` (word, n).

    The ``extra`` words count at least as often as the model's middle word. A run's substrings are joined with the
    model; words longer than ``PREFIX`` are joined by their beginning and then compared whole, so none is left out.
    """
    spark = runs.sparkSession
    told = model.agg(F.coalesce(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY n)"), F.lit(1)).cast("long").alias("middle")).first()
    listed = spark.createDataFrame([(w, told["middle"]) for w in extra], "word string, n long")
    model = stored(model.unionByName(listed).groupBy("word").agg(F.max("n").alias("n")), "unigrams")
    splitter = Segmenter(model.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    runs = stored(runs.select("run", F.monotonically_increasing_id().alias("rid")), "runs")
    begins = runs.select("rid", "run", F.explode(F.sequence(F.lit(1), F.length("run"))).alias("i"))
    ends = F.sequence(F.lit(1), F.least(F.lit(PREFIX), F.length("run") - F.col("i") + 1))
    parts = begins.select("rid", "run", "i", F.explode(ends).alias("k")).select("rid", F.expr("substring(run, i, k)").alias("word")).distinct()
    parts = stored(parts, "substrings")
    short = attach(parts, model.where(F.length("word") <= PREFIX), "word").select("rid", "word", "n")
    long = model.where(F.length("word") > PREFIX).select(F.substring("word", 1, PREFIX).alias("word"), F.col("word").alias("whole"), "n")
    begun = attach(parts.where(F.length("word") == PREFIX), long, "word").select("rid", "whole", "n")
    begun = begun.join(runs, "rid").where(F.contains("run", "whole")).select("rid", F.col("whole").alias("word"), "n")
    found = short.unionByName(begun).groupBy("rid").agg(F.collect_list(F.struct("word", "n")).alias("found"))  # words that occur in one run

    def split(batches):
        for batch in batches:
            pairs = zip(batch.column("run").to_pylist(), batch.column("found").to_pylist(), strict=True)
            words = [splitter.words(run, {w["word"]: w["n"] for w in own or ()}) for run, own in pairs]
            yield pa.RecordBatch.from_arrays([batch.column("run"), pa.array(words, pa.list_(pa.string()))], names=["run", "words"])

    return runs.join(found, "rid", "left").select("run", "found").mapInArrow(split, "run string, words array<string>")


def token_odds(tokens: DataFrame, bad: int, good: int) -> DataFrame:
    """Rows (token, odds) from (token, n, bad): the log-odds that multinomial naive Bayes gives a token.

    Counts are smoothed towards the shares of all tokens. ``bad`` and ``good`` are the numbers of examples; with
    examples of one class alone no token says anything.
    """
    if not bad or not good:
        return tokens.where("false").select("token", F.lit(0.0).alias("odds"))
    total, all_bad = tokens.agg(F.sum("n"), F.sum("bad")).first()

    def share(own, of: int):
        return F.log((own + F.lit(SMOOTHING) * F.col("n") / F.lit(float(total))) / F.lit(of + SMOOTHING))

    return tokens.select("token", (share(F.col("bad"), all_bad) - share(F.col("n") - F.col("bad"), total - all_bad)).alias("odds"))


def log_odds(sites: DataFrame, model: DataFrame, block_words=BLOCK_WORDS) -> DataFrame:
    """Rows (site, log_odds) for stored ``sites`` (site, host, path, n), n being the rows with that host and path.

    The tokens of a site are the words of its host, and those of its path marked by a slash. It is an example of "block"
    if one of them is a listed word, else of "allow". ``log_odds`` are those of the examples plus those of the tokens.
    """
    letters = lambda c: F.regexp_extract_all(F.lower(F.col(c)), F.lit("[a-z]+"), F.lit(0))
    runs = sites.select("site", F.explode(F.concat(
        F.transform(letters("host"), lambda r: F.struct(F.lit("").alias("mark"), r.alias("run"))),
        F.transform(letters("path"), lambda r: F.struct(F.lit("/").alias("mark"), r.alias("run"))))).alias("r")).select("site", "r.mark", "r.run")
    runs = stored(runs.groupBy("site", "mark", "run").agg(F.count("*").alias("k")), "site-runs")
    words = stored(segmented(runs.select("run").distinct(), model, block_words), "segments")
    split = attach(runs, words, "run").select("site", "mark", "k", F.explode("words").alias("word"))
    tokens = split.groupBy("site", F.concat("mark", "word").alias("token")).agg(F.sum("k").alias("k"))
    tokens = stored(tokens, "site-tokens")
    listed = tokens.where(F.col("token").isin([p + w for w in block_words for p in ("", "/")])).select("site").distinct()
    marked = stored(sites.select("site", "n").join(listed.withColumn("hit", F.lit(1)), "site", "left").select("site", "n", F.coalesce("hit", F.lit(0)).alias("hit")), "examples")
    n, bad = marked.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.col("n") * F.col("hit")), F.lit(0))).first()
    counted = tokens.join(marked, "site").groupBy("token").agg(F.sum(F.col("k") * F.col("n")).alias("n"), F.sum(F.col("k") * F.col("n") * F.col("hit")).alias("bad"))
    odds = stored(token_odds(stored(counted, "tokens"), bad, n - bad), "odds")
    scored = attach(tokens, odds, "token").groupBy("site").agg(F.sum(F.col("k") * F.col("odds")).alias("odds"))
    prior = math.log(bad + 0.5) - math.log(n - bad + 0.5)
    return sites.select("site").join(scored, "site", "left").select("site", (F.coalesce("odds", F.lit(0.0)) + prior).alias("log_odds"))


def judged(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html", rules=RULES, block_words=BLOCK_WORDS) -> DataFrame:
    """Rows (id, host, path, rule, verdict, log_odds): the rule's verdict where one fits, else the model's.

    ``log_odds`` are the model's for every row; above 0 it says block, at 0 and below it says allow. A null url, or one
    without ``://``, has an empty host and path and is judged like others. Rows that repeat an id each get a result,
    equal urls the same one. Other columns are not read. No rows: an empty result.
    """
    urls = pages.select(F.col(id).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    sites = urls.groupBy("host", "path").agg(F.count("*").alias("n")).select(F.monotonically_increasing_id().alias("site"), "host", "path", "n")
    sites = stored(sites, "sites")
    scored = sites.join(log_odds(sites, stored(unigrams(pages, html), "words"), block_words), "site").select("host", "path", "log_odds")
    rule, verdict = rule_and_verdict("host", "path", rules)
    out = attach(urls, stored(scored, "scored"), ["host", "path"])
    verdict = F.coalesce(verdict, F.when(F.col("log_odds") > 0, "block").otherwise("allow"))
    return out.select(F.col("id").alias(id), "host", "path", rule.alias("rule"), verdict.alias("verdict"), "log_odds")
