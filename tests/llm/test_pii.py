"""Personal data against the contract's patterns written out, and each rule on its own."""

import hashlib
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickflow.llm import pii, queries
from clickflow.llm.common import read_table

CONTRACT = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, found):
    digits = [int(c) for c in found if c in "0123456789"]
    if kind == "ip":
        return all(int(part) <= 255 for part in found.split("."))
    if kind == "card":
        doubled = [sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(digits[::-1])]
        return 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def plain(text):
    """(start, rule, end) of the base kinds."""
    found = [
        (m.start(), order, m.end())
        for order, (kind, pattern) in enumerate(CONTRACT.items())
        for m in re.finditer(pattern, text or "", re.ASCII)
        if holds(kind, m[0])
    ]
    return sorted(found)


def base_spans(text):
    return [s[:3] for s in pii.spans_of(text or "") if s[1] < 4]


TEXTS = [
    "mail a@b.c+d@e.f, x@y@z.com. a@b. .@-.- ü@x.de é.x@y-z.co.uk.",
    "ip 1.2.3.4.5.6.7.8 and 256.1.1.1 01.002.0003.255 1..2.3.4 999999999999999999999.1.1.1 1.2.3",
    "card 4225039295678253, 4225 0392 9567 8253 and 4225-0392-9567-8254; 4225039295678253 1 4111111111111111",
    "call +1 (974) 555-3436 or +49 30 123456 7. +12 +1 2 +44-20-7946-0958-12345678 ++1 555 555 5555",
    "+1 4111 1111 1111 1111 9 +4111111111111111 1.2.3.4@5.6.7.8",
    "",
    None,
    "nothing here\n" * 50,
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans_match_the_contract(text):
    assert base_spans(text) == plain(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a@.+-0123459 ()%é\n", max_size=80))
def test_base_spans_of_odd_texts(text):
    assert base_spans(text) == plain(text)


def test_checksums():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod_97("GB82WEST12345698765432") and not pii.mod_97("GB82WEST12345698765433")


def kinds(text):
    return [(pii.RULES[order].kind, text[start:end]) for start, order, end, _ in pii.spans_of(text) if order >= 4]


def test_account_numbers_need_their_checksum_and_length():
    assert kinds("pay to GB82 WEST 1234 5698 7654 32 THAT IS ALL") == [("iban", "GB82 WEST 1234 5698 7654 32")]
    assert kinds("DE89370400440532013000.") == [("iban", "DE89370400440532013000")]
    for wrong in ("GB82 WEST 1234 5698 7654 33", "DE893704004405320130001", "XX89370400440532013000", "DE8937040044"):
        assert kinds(wrong) == []


def test_forms_without_checksum_need_context():
    assert kinds("her SSN is 078-05-1120") == [("ssn", "078-05-1120")]
    assert kinds("part 078-05-1120 of the list") == []
    assert kinds("SSN 000-05-1120, 666-05-1120, 900-05-1120, 078-00-1120, 078-05-0000, 078-05-11201") == []
    assert kinds("a placeholder ssn: 078-05-1120") == []
    assert kinds("Call (555) 555-3436 now or 555.555.3437") == [("local_phone", "(555) 555-3436"), ("local_phone", "555.555.3437")]
    assert kinds("the numbers 555 555 3436") == []


def test_devices():
    assert kinds("0a:1B:2c:3D:4e:5F") == [("mac", "0a:1B:2c:3D:4e:5F")]
    assert kinds("2001:db8:0:0:1:0:0:1") == [("ipv6", "2001:db8:0:0:1:0:0:1")]
    assert kinds("2001:db8:0:0:1:0:0:1g 0a:1B:2c:3D:4e:5F:60 1:2:3:4:5:6:7:8:9") == []


def test_added_spans_stay_off_base_spans():
    text = "phone +1 (974) 555-3436"
    assert [s[1] for s in pii.spans_of(text)] == [3]


def test_context_moves_the_score():
    by_text = {t: pii.spans_of(t)[0][3] for t in ("host 10.0.0.1", "x 10.0.0.1", "version 10.0.0.1", "hosting 10.0.0.1")}
    scores = list(by_text.values())
    assert scores[0] > scores[1] > scores[2] and scores[3] == scores[1]
    far = "phone" + " " * pii.CONTEXT + "+1 (974) 555-3436"
    assert pii.spans_of(far)[0][3] < pii.spans_of(far.replace("  ", " "))[0][3]


@pytest.mark.parametrize("unit", ["a", "1", "1.", "1 ", "a@", "a.", "+1", "0a:", "(", "555-", "A1", "a@b.c", "+ "])
def test_long_texts_take_linear_time(unit):
    began = time.process_time()
    pii.spans_of(unit * (1_000_000 // len(unit)))
    assert time.process_time() - began < 30


def test_nulls_repeated_rows_and_clashing_names(documents):
    rows = [(1, "a@b.c"), (1, "a@b.c"), (None, "x +1 (974) 555-3436 a@b.c"), (2, None), (3, "")]
    df = documents(*rows).withColumnsRenamed({"component": "__spans", "host": "key", "label": "start"})
    found = sorted((str(r.doc_id), len(r["__spans"])) for r in pii.pii_spans(df).collect())
    assert found == [("1", 1), ("1", 1), ("2", 0), ("3", 0), ("None", 2)]
    masked = pii.mask_pii(df)
    assert masked.schema == df.schema
    texts = sorted((str(r.doc_id), str(r.text)) for r in masked.collect())
    assert texts == [("1", "[email]"), ("1", "[email]"), ("2", "None"), ("3", ""), ("None", "x [phone] [email]")]
    assert pii.pii_spans(documents()).count() == 0 and pii.mask_pii(documents()).count() == 0


def test_masks_of_overlapping_spans_join(documents):
    text = "é +411111111111; 1.2.3.4@5.6.7.8 ü"
    assert [s[1] for s in pii.spans_of(text)] == [3, 0, 1, 1]
    assert pii.mask_pii(documents((1, text))).first().text == "é [phone]; [email] ü"


def test_own_rules(documents):
    rules = (pii.Rule("id", r"id-[0-9]{2}", 0.1), pii.Rule("code", "c[0-9]", 0.4, speaks_for="code"))
    df = pii.pii_spans(documents((1, "id-12 code c3 id-4")), rules=rules, base=1)
    assert df.select(pii.span_text(df["__spans"], rules)).first()[0] == "id:0:5,code:11:13"


def contract_row(doc, text):
    spans = plain(text)
    shown = ",".join(f"{list(CONTRACT)[order]}:{start}:{end}" for start, order, end in spans)
    counts = tuple(sum(s[1] == order for s in spans) for order in range(4))
    return (doc, *counts, hashlib.sha256(shown.encode()).hexdigest())


def test_registered_query_on_the_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = read_table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    found = queries.op12_pii(spark, sf_dir).collect()
    got = sorted((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in found)
    assert got == sorted(contract_row(*row) for row in rows)
    assert all(sum(row[i] for row in got) for i in range(1, 5))
    texts = {row.doc_id: row.text for row in rows}
    for row in found:
        named = [f"{pii.RULES[o].kind}:{a}:{b}" for a, o, b, _ in pii.spans_of(texts[row.doc_id] or "")]
        assert row.spans == ",".join(named)
        assert hashlib.sha256(",".join(n for n in named if n.split(":")[0] in CONTRACT).encode()).hexdigest() == row.base_sha256
