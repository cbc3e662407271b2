"""Base spans against the plain patterns, checksums, added spans, odd tables."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from shoalgrid.llm import pii


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0


def base(text):
    out = [(m.start(), 0, "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, "ip", m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, "card", m.end()))
    out += [(m.start(), 3, "phone", m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return [(k, s, e) for s, _, k, e in sorted(out)]


def own(text):
    return [x[:3] for x in pii.find(text) if x[0] in pii.BASE_KINDS]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a1.@ -+()9Z0٣é\n", max_size=70))
def test_base_spans_equal_the_patterns(text):
    assert own(text) == base(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="124-+ .5@a", max_size=80))
def test_base_spans_in_digit_strings(text):
    assert own(text) == base(text)


def test_added_spans_need_a_checksum_or_a_word_nearby():
    kinds = lambda t: [x[0] for x in pii.find(t)]
    assert kinds("IBAN DE89 3704 0044 0532 0130 00 please") == ["iban"]
    assert "iban" not in kinds("IBAN DE88 3704 0044 0532 0130 00 please")
    assert kinds("her ssn is 123-45-6789.") == ["ssn"] and kinds("part 123-45-6789.") == []
    assert kinds("call (212) 555-0100 now") == ["local_phone"] and kinds("item (212) 555-0100 now") == []
    near, far = pii.find("visa 4111111111111111")[0][3], pii.find("item 4111111111111111")[0][3]
    assert near > far >= pii.THRESHOLD
    assert pii.redact("mail a@b.org or +1 (212) 555-0100.") == "mail <EMAIL> or <PHONE>."


def test_long_digit_strings_take_linear_time():
    assert own("1" * 200_000 + " " + "a" * 200_000 + "@") == base("1" * 20 + " ")
    assert len(own("a@b.cd " * 20_000)) == 20_000


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = pii.personal_data(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = base(texts[r["doc_id"]])
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.BASE_KINDS] == [sum(x[0] == k for x in want) for k in pii.BASE_KINDS]
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))


def test_odd_tables(spark):
    docs = spark.createDataFrame([(None, "a@b.org", 1), (1, None, 2), (1, "", 3), (1, None, 2)], "doc_id long, text string, spans int")
    found = sorted(((r["doc_id"] or 0, r["n_email"], r["spans"]) for r in pii.personal_data(docs).collect()))
    assert found == [(0, 1, "email:0:7"), (1, 0, ""), (1, 0, ""), (1, 0, "")]
    assert pii.personal_data(docs.limit(0)).collect() == []


def test_ibans_side_by_side_and_behind_a_word_of_their_shape():
    spans = lambda t: [x[1:3] for x in pii.find(t) if x[0] == "iban"]
    assert spans("BE68539007547034 BE68539007547034") == [(0, 16), (17, 33)]
    assert spans("NO9386011117947 NO9386011117947") == [(0, 15), (16, 31)]
    assert spans("BE68 5390 0754 7034 BE68 5390 0754 7034") == [(0, 19), (20, 39)]
    assert spans("AB12 INVOICE NO9386011117947") == [(13, 28)]
    assert len(spans("NO9386011117947 " * 5_000)) == 5_000
