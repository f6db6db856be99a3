import random
import re

import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwise.llm import licenses, queries
from shelfwise.llm.licenses import BASE, FAMILIES, LOOSER, NOTICES
from shelfwise.llm.tokens import ascii_lower
from tests.llm.helpers import no_documents, odd_documents

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCANNER = licenses.Scanner()


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(text, phrases):
    words = words_of(text)
    return sorted((i, i + len(p.split()), label) for p, label in phrases.items()
                  for i in range(len(words)) if words[i:i + len(p.split())] == p.split())


def descend(tokens):
    """Value of a well-formed expression by recursive descent."""
    def either():
        value = both()
        while tokens and tokens[0] == "or":
            tokens.pop(0)
            value = min(value, both())
        return value

    def both():
        value = single()
        while tokens and tokens[0] == "and":
            tokens.pop(0)
            value = max(value, single())
        return value

    def single():
        token = tokens.pop(0)
        value = FAMILIES[licenses.family(token)] if token != "(" else either()
        if token == "(":
            tokens.pop(0)
        while tokens and tokens[0] == "with":
            del tokens[:2]
            value *= LOOSER
        return value

    return either()


IDS = ["mit", "gpl-2.0-only", "apache-2.0", "agpl-3.0+", "cc-by-nc-4.0", "licenseref-x", "bsd-3-clause"]
EXPRESSIONS = st.recursive(
    st.sampled_from(IDS) | st.sampled_from(IDS).map(lambda x: f"{x} with classpath-exception-2.0"),
    lambda inner: st.tuples(inner, st.sampled_from(["and", "or"]), inner).map(" ".join)
    | inner.map(lambda e: f"( {e} )"), max_leaves=12)


@given(EXPRESSIONS)
def test_expressions_as_by_recursive_descent(text):
    value, labels = licenses.evaluate(licenses.tokens(f": {text}".encode(), 0, len(text) + 2))
    assert value == pytest.approx(descend(text.split()))
    own = [t for t, before in zip(text.split(), ["", *text.split()]) if before != "with"]
    assert labels == sorted({licenses.family(t) for t in own if t not in ("and", "or", "with", "(", ")")})


@pytest.mark.parametrize("text,expected", [
    ("mit", (0.1, ["mit"])), ("mit or", (0.1, ["mit"])), ("(mit and (gpl-3.0 or", (0.7, ["gpl", "mit"])),
    ("mit mit gpl", (0.1, ["mit"])), (") mit", None), ("", None), ("and mit", None), ("((", None),
    ("mit) and gpl", (0.1, ["mit"])), ("gpl-2.0 with", (0.7, ["gpl"])), ("gpl with (mit)", (0.7, ["gpl"])),
    ("mit and gpl or apache", (0.15, ["apache", "gpl", "mit"])), ("foo", (0.6, ["unknown"])), ("cc0-1.0", (0.05, ["cc0"])),
    ("mit -->", (0.1, ["mit"]))])
def test_longest_beginning(text, expected):
    assert licenses.evaluate(licenses.tokens(text.encode(), 0, len(text))) == expected


def test_families():
    told = {"gpl-2.0-or-later": "gpl", "gplv3": "unknown", "bsd-2-clause": "bsd", "cc-by-4.0": "cc-by",
            "cc-by-sa-4.0": "cc-by-sa", "apache2": "apache", "mit-0": "mit", "lgpl": "lgpl", "cc": "unknown"}
    assert {k: licenses.family(k) for k in told} == told


def test_phrases_as_by_brute_force():
    rng = random.Random(4)
    vocabulary = sorted({w for p in [*BASE, *NOTICES] for w in p.split()}) + ["zebra", "ÜBER", "xx"]
    texts = []
    for _ in range(300):
        picked = [rng.choice(list(BASE) + list(NOTICES)) if rng.random() < 0.3 else rng.choice(vocabulary)
                  for _ in range(rng.randint(0, 30))]
        texts.append(rng.choice(["", "-"]) + "".join(w + rng.choice([" ", "-", "\n", ", ", "_", "\x7f"]) for w in picked))
    texts += ["CC BY", "CC-BY-NC 4.0", "ccby", "cc by cc by", " cc by", "all rights reserved all rights reserved"]
    finds, n_words = licenses.scan(ascii_lower(pa.array(texts)), SCANNER)
    assert n_words.tolist() == [len(words_of(t)) for t in texts]
    for r, text in enumerate(texts):
        own = [f for f in finds if f.row == r]
        assert sorted((f.start, f.end, f.label) for f in own if f.base) == brute(text, BASE)
        assert sorted((f.start, f.end, f.label) for f in own) == sorted(brute(text, BASE) + brute(text, NOTICES))


def test_tags_and_scores(spark):
    texts = {1: "x\n# SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND Apache-2.0\nAll Rights", 2: "license-expression: ",
             3: "GNU Lesser General Public License", 4: "spdx license identifier\nmit", 5: "CC-BY-NC and CC BY",
             6: "SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 */ all, rights; RESERVED"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in licenses.license_report(df).collect()}
    assert (rows[1]["labels"], rows[1]["score"], rows[1]["n_base"], rows[1]["base_labels"]) == ("apache,gpl,mit", 0.15, 0, "")
    assert (rows[2]["labels"], rows[2]["score"], rows[2]["first_word"]) == ("", 0.0, None)
    assert (rows[3]["labels"], rows[3]["score"], rows[3]["base_labels"]) == ("gpl,lgpl", 0.5, "gpl")
    assert rows[4]["labels"] == ""
    assert (rows[5]["labels"], rows[5]["n_base"], rows[5]["first_word"], rows[5]["last_word"]) == ("cc-by,cc-by-nc", 2, 0, 4)
    assert (rows[6]["labels"], rows[6]["score"], rows[6]["n_words"]) == ("gpl,reserved", 1.0, 15)


def test_odd_documents(spark):
    found = licenses.license_report(odd_documents(spark, ["all rights reserved " * 40_000]))
    rows = found.collect()
    assert len(rows) == 10
    assert {r["doc_id"]: r["n_words"] for r in rows if r["doc_id"] in (1, 2, 3, 6)} == {1: 0, 2: 0, 3: 0, 6: 0}
    long = next(r for r in rows if r["doc_id"] == 100)
    assert (long["n_base"], long["first_word"], long["last_word"]) == (40_000, 0, 3 * 39_999)
    assert licenses.license_report(no_documents(spark)).count() == 0


def test_query_on_whole_table(spark, sf_dir):
    found = {r["doc_id"]: r for r in queries.op12(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(found) == len(docs) and any(r["n_base"] for r in found.values())
    for d in docs:
        told, places = found[d["doc_id"]], brute(d["text"], BASE)
        assert told["n_words"] == len(words_of(d["text"])) and told["n_base"] == len(places)
        assert told["first_word"] == min((p[0] for p in places), default=None)
        assert told["last_word"] == max((p[0] for p in places), default=None)
        assert told["base_labels"] == ",".join(sorted({p[2] for p in places}))
        assert set(told["base_labels"].split(",")) - {""} <= set(told["labels"].split(",")) and 0 <= told["score"] <= 1
