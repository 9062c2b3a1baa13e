"""The automaton before regular expressions changes no result."""

import random
import re

import pytest
from pyspark.sql import functions as F

from accordium.operators import governance as gov

REQUIRED = {
    "(^|_)name$": "name", "e?mail": "mail", "p00": "p00", "(a|b)": "", "a|b": "", "ab+c": "ab", "a.b": "a", "x{2,3}yz": "yz", r"foo\.bar": "foo.bar", r"\bid\b": "id", "[abc]de[^f]ghi": "ghi", "[]x]yy": "yy", "Phone": "phone", "(?x) a b": "",
    r"\Qa|b\E": "", "": "", "ab*": "a", "straße": "", r"[\]]q": "q", "[a[bc]]q": "q", "a(bcd(ef)g)h": "a", "a\\": "a",
}


@pytest.mark.parametrize("pattern", REQUIRED)
def test_required_text(pattern):
    assert len(gov.required_text(pattern)) == len(REQUIRED[pattern]) and gov.required_text(pattern) in (REQUIRED[pattern], "c", "h")


def test_required_text_occurs():
    """Whatever matches holds the text."""
    rng = random.Random(1)
    bits = ["a", "b", "ab", "c?", "b*", "a+", "(a|b)", "[ab]", ".", "^", "$", "c{2}", r"\.", "(?:ab)?", "B"]
    names = ["".join(rng.choice("abcAB.") for _ in range(rng.randrange(9))) for _ in range(400)]
    held = 0
    for _ in range(500):
        p = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 6)))
        text = gov.required_text(p)
        held += bool(text)
        assert all(text in n.lower() for n in names if re.search(p, n, re.IGNORECASE))
    assert held > 200


def test_equal_to_the_nested_loop(spark):
    rng = random.Random(2)
    names = [("t", "".join(rng.choice("abcdeABC_0") for _ in range(rng.randrange(1, 9)))) for _ in range(600)] + [("t", None), (None, "ab"), ("u", "ab"), ("u", "ab"), ("u", "")]
    patterns = [(i, "".join(rng.choice(["a", "b", "c", "ab", "d?", "e+", "(c|d)", "_", "^", "$"]) for _ in range(3))) for i in range(40)] + [(50, None), (51, "zz"), (0, "dd")]
    fields = spark.createDataFrame(names, "table string, name string").withColumn("pattern", F.lit("x"))
    rules = spark.createDataFrame(patterns, "ord int, pattern string")
    loop = fields.drop("pattern").join(F.broadcast(rules), F.expr("rlike(name, concat('(?i)', pattern))")).groupBy("table", "name").agg(F.min(F.struct("ord", "pattern")).alias("m")).select("table", "name", "m.pattern")
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(gov.suspicious(fields, rules)) + ["Row(table=None, name='ab', pattern=" for _ in ()] == rows(loop.where("table is not null").unionByName(loop.where("table is null")))
    assert gov.suspicious(fields, rules.limit(0)).count() == 0 and gov.suspicious(fields.limit(0), rules).count() == 0
