import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import pii
from tests.llm.helpers import no_documents, odd_documents

RULES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain(text):
    """The rules as they are stated."""
    out = []
    for kind, rule in RULES.items():
        for m in re.finditer(rule, text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits)))
            sound = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                     "card": 14 <= len(digits) <= 19 and total % 10 == 0, "phone": 10 <= len(digits) <= 15}[kind]
            if sound:
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], list(RULES).index(s[0])))


PIECES = ["a@b.c", "@", ".", "x.y@m-1.de.f", "_", "%", "12", "255", "256", "1.2.3.4", "0.0.0.0", "+", "+1 ", "(988) ", "555-2485",
          "4465758382889437", "4465 7583 8288 9437", " ", "-", "é", "\n", "a", "@b.c_d@e.f", "007"]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=9).map("".join))
def test_base_rules(text):
    assert pii.base_spans(text) == plain(text)


def test_long_runs_are_linear():
    for text in ("a" * 200_000 + "@", "1" * 200_000, "1." * 100_000, "+1" * 100_000, "@" * 100_000, "a.b" * 50_000 + "@x"):
        pii.base_spans(text)


def test_field_adds_what_the_rules_drop(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    field = pii.train_field(docs)
    texts = ["call +1 (269) 555-3296 4465758382889437 now", "no data 4465758382889438 here, 12 of 30", "x a.b@mail.example.com",
             None, "4465758382889437 4465758382889437"]
    found = pii.find_spans(texts, field)
    for text, (base, spans) in zip(texts, found):
        assert base == (plain(text) if text else []) and set(base) <= set(spans)
        assert all(a >= 0 and b <= len(text) for _, a, b in spans)
    assert [s[0] for s in found[0][1]] == ["phone", "card"] and found[0][0] == []
    assert found[1][1] == [] and len(found[4][1]) == 2
    alone = [pii.find_spans([t], field)[0] for t in texts]
    assert alone == found  # one graph for all documents gives each its own result
    rows = pii.find_pii(docs, field).join(docs, "doc_id").toPandas()
    for text, digest, spans in zip(rows.text, rows.base_sha256, rows.spans):
        base = pii.joined_spans(plain(text))
        assert digest == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(spans.split(","))


def test_messages_equal_enumeration():
    """On a chain, sum-product is exact."""
    rng = np.random.default_rng(0)
    field = pii.Field(rng.normal(size=(pii.FEATURES, pii.LABELS)), rng.normal(size=(pii.LABELS, pii.LABELS)),
                      np.zeros((pii.LABELS, pii.LABELS)))
    features = [[0, 5], [2], [3, 7]]
    found = pii.beliefs(field, features, np.array([(0, 1), (1, 2)]), np.zeros((0, 2), int), (np.zeros(3), np.zeros(3)))
    u = [field.unary[f].sum(axis=0) for f in features]
    joint = np.exp(u[0][:, None, None] + u[1][None, :, None] + u[2][None, None, :] + field.move[:, :, None] + field.move[None])
    joint /= joint.sum()
    for i in range(3):
        assert np.allclose(found[i], joint.sum(axis=tuple(j for j in range(3) if j != i)), atol=1e-3)


def test_odd_rows(spark):
    docs = odd_documents(spark, ["mail a@b.co or A@B.co", "1.2.3.4"])
    for field in (None, pii.train_field(docs)):
        rows = {(r.doc_id, r.spans) for r in pii.find_pii(docs, field).collect()}
        assert (100, "email:5:11,email:15:21") in rows and (101, "ip:0:7") in rows and (1, "") in rows
        masked = pii.mask_pii(docs, field)
        assert masked.columns == docs.columns and masked.count() == docs.count()
        assert masked.where("doc_id = 100").first().text == "mail <email> or <email>"
        assert masked.where("doc_id = 100").first().n_chars == len("mail <email> or <email>")
        assert masked.where("doc_id = 1").first().text is None
    assert pii.train_field(no_documents(spark)) is None
    assert pii.find_pii(no_documents(spark), None).count() == 0
