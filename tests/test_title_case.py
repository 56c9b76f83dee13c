"""Title case against str.title over every letter of the basic plane, with neighbours with and without case."""

import sys
import unicodedata

from pyspark.sql import functions as F

from tillsight.functions.text import title_case

FRAMES = ["{}", "a{}", "{}a", "a{}b", " {}B", "1{}A", "B{} c{}", "中{}a"]


def test_every_letter_of_the_basic_plane(spark):
    letters = [chr(i) for i in range(sys.maxunicode + 1) if i < 0x10000 and unicodedata.category(chr(i))[0] == "L"]
    rows = [(ch, f.replace("{}", ch)) for ch in letters for f in FRAMES]
    got = spark.createDataFrame(rows, "ch string, t string").repartition(8).select("ch", "t", title_case("t").alias("x")).collect()
    wrong = {}
    for r in got:
        if r.x != r.t.title():
            wrong.setdefault(r.ch, []).append((r.t, r.x, r.t.title()))
    # The JVM's regular expressions, its case mappings and Python follow different versions of Unicode: letters that the JVM does
    # not know yet, two that had no case in its version, and two whose capitals are newer than Python's tables.
    known = spark._jvm.java.lang.Character
    wrong = {ch: w for ch, w in wrong.items() if known.isDefined(ord(ch)) and ch not in "\uab69\u10fc\u019b\u0264"}
    assert not wrong, (len(wrong), [(hex(ord(k)), v[:2]) for k, v in list(wrong.items())[:12]])


def test_words_blanks_and_nulls(spark):
    texts = ["cote d'ivoire", "NATION_0", "中a", "straße ßa", "ǆ xǆ", "", "  two  blanks ", None, "O'NEIL-smith 3RD", "ΟΔΟΣ ΣΑΣ", "İSTANBUL İA", "a" * 5000 + " b"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", title_case("t").alias("x")).collect()
    assert [r.x for r in got] == [None if t is None else t.title() for t in texts]
