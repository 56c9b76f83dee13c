import re

from pyspark.sql import functions as F

from tillsight.llm import quality

from .helpers import documents, empty, odd


def brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    first, again = {}, set()
    for i in range(len(w) - 4):
        k = tuple(w[i:i + 5])
        if k in first:
            again |= {*range(i, i + 5), *range(first[k], first[k] + 5)}
        else:
            first[k] = i
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again),
            len(w) < 10 or 100 * len(again) > 20 * len(w))


def got(r):
    return tuple(r[k] for k in (*quality.COUNTS, "base_failed"))


def test_documents_against_brute_force(spark):
    docs = documents(spark)
    for r in quality.judge(docs).collect():
        assert got(r) == brute(r["text"])
        assert not (r["base_failed"] and r["kept"])


def test_no_python_on_the_main_path(spark):
    plan = quality.counted(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_repeats_that_overlap(spark):
    cases = ["a a a a a", "a a a a a a", "a b c d e f a b c d e", "a b c d e " * 4, "x " * 4, "1 2 3 4 5 6 7 1 2 3 4 5 6 8"]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(cases)], "doc_id long, text string, source string")
    for r in quality.counted(docs).collect():
        assert got(r) == brute(r["text"]), r["text"]


def test_host_verdicts_shrink(spark):
    good = "these are plainly different words in one fairly normal sentence number {}"
    rows = [(good.format(i), "fine") for i in range(200)] + [("bad", "worse")] * 80 + [("bad", "small")]
    rows += [(good.format(f"x{i}"), "worse") for i in range(20)] + [(good.format(f"y{i}"), None) for i in range(30)]
    docs = spark.createDataFrame([(i, t, s) for i, (t, s) in enumerate(rows)], "doc_id long, text string, source string")
    out = quality.judge(docs).collect()
    rates = {r["host"]: r for r in quality.host_verdicts(quality.counted(docs)).collect()}
    assert rates["worse"]["rejected"] and not rates["fine"]["rejected"] and not rates[None]["rejected"]
    assert rates["small"]["rate_base"] < 1 and rates["fine"]["rate_base"] > 0       # drawn to the prior
    assert not any(r["kept"] for r in out if r["source"] == "worse")               # also its good documents
    assert all(r["kept"] for r in out if r["source"] in ("fine", None))


def test_odd_rows_and_empty(spark):
    rows = quality.judge(odd(spark)).collect()
    assert len(rows) == 12
    for r in rows:
        assert got(r) == brute(r["text"])
    kept = quality.keep_good(odd(spark).withColumn("q_kept", F.lit(1)))
    assert kept.columns == [*odd(spark).columns, "q_kept"]
    assert quality.judge(empty(spark)).count() == 0
