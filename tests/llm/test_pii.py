from __future__ import annotations

import hashlib
import random
import re

from helpers import ODD, documents, frame, save

from inkmill.llm.pii import luhn, masked, mod97, op3_pii, redact, spans_of

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def base(text):
    text = text or ""
    digits = lambda s: [int(c) for c in s if c.isdigit()]

    def good_card(s):
        d = digits(s)[::-1]
        return 16 <= len(d) <= 19 and (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0

    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if good_card(m[0])]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]


def row(text):
    spans = base(text)
    return [sum(s[0] == k for s in spans) for k in ("email", "ip", "card", "phone")], hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def test_base_spans_equal_a_plain_scan(spark, sf):
    got = {r.doc_id: ([r.n_email, r.n_ip, r.n_card, r.n_phone], r.base_sha256) for r in op3_pii(spark, sf).collect()}
    assert got == {r.doc_id: row(r.text) for r in documents(sf).itertuples()}


def test_random_strings():
    rng = random.Random(5)
    for _ in range(4000):
        text = "".join(rng.choices("a1.@+- (25x_9\n", k=rng.randrange(60)))
        assert [s[:3] for s in spans_of(text) if s[0] in ("email", "ip", "card", "phone")] == base(text), repr(text)


def test_odd_texts(spark, tmp_path):
    texts = [t for t in ODD if t is None or len(t) < 5000] + ["mail a.b@c.de now", "4111 1111 1111 1111 pay", "call +49 (30) 123456-7", "1.2.3.4.5.6.7.8 256.1.1.1"]
    df = frame(spark, texts)
    got = {r.doc_id: ([r.n_email, r.n_ip, r.n_card, r.n_phone], r.base_sha256) for r in op3_pii(spark, save(df, tmp_path)).collect()}
    assert got == {i: row(t) for i, t in enumerate(texts)}
    assert op3_pii(spark, save(df.limit(0), tmp_path)).count() == 0


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 150_000, "+1" * 150_000, "AA00" * 80_000):
        spans_of(text)


def test_checksums_and_context():
    assert luhn("4111111111111111") and not luhn("4111111111111112")
    assert mod97("DE89370400440532013000") and not mod97("DE89370400440532013001")
    kinds = lambda t: [s[0] for s in spans_of(t)]
    assert kinds("IBAN DE89 3704 0044 0532 0130 00 please") == ["iban"]
    assert kinds("ssn 123-45-6789") == ["ssn"] and kinds("part 123-45-6789") == []
    near, far = spans_of("email me: a@b.de")[0][3], spans_of("see a@b.de")[0][3]
    assert near > far


def test_redaction_masks_and_keeps_columns(spark):
    df = frame(spark, ["write a@b.de or +49 30 1234567.", "clean", None])
    out = {r.doc_id: r for r in redact(df, lengths="n_chars").collect()}
    assert out[0].text == "write [EMAIL] or [PHONE]." and out[0].n_chars == len(out[0].text)
    assert out[1].text == "clean" and out[2].text is None
    assert masked("abcdef", [("ip", 1, 4, 1.0), ("card", 2, 5, 1.0)]) == "a[IP]f"


def test_adjacent_ibans_and_all_countries():
    from inkmill.llm.pii import spans_of

    for text in ("DE89370400440532013000 GB82WEST12345698765432", "DE00370400440532013000 GB82WEST12345698765432", "AB12 GB82WEST12345698765432"):
        found = [text[a:b] for kind, a, b, _ in spans_of(text) if kind == "iban"]
        assert found[-1] == "GB82WEST12345698765432" and len(found) == text.count("DE89") + 1
    for iban in ("RO49AAAA1B31007593840000", "HU42117730161111101800000000", "GR1601101250000000012300695", "TR330006100519786457841326"):
        assert [iban] == [iban[a:b] for kind, a, b, _ in spans_of(iban) if kind == "iban"]


def test_long_texts_give_what_a_plain_scan_gives():
    for text in ("a" * 4000, "1" * 4000, "1." * 2000, "a@" * 2000, "+1" * 2000, "1.2.3.4 " * 500, "x@y.zz " * 600, "4111 1111 1111 1111, " * 200, "+49 30 123456; " * 300, "a.b@" * 700 + "c.de"):
        assert [s[:3] for s in spans_of(text) if s[0] in ("email", "ip", "card", "phone")] == base(text), text[:20]


def plain_ibans(text):
    """From every place in turn: a country, two digits and what its length asks for, single spaces between; no letter or digit around."""
    from inkmill.llm.pii import IBAN_LENGTH

    out, i = [], 0
    while i < len(text):
        need = IBAN_LENGTH.get(text[i : i + 2], 0) if i == 0 or not (text[i - 1].isascii() and text[i - 1].isalnum()) else 0
        have, k = "", i
        while need and k < len(text) and len(have) < need:
            if text[k] == " " and len(have) >= 4 and text[k - 1] != " ":
                k += 1
            elif text[k].isascii() and (text[k].isupper() or text[k].isdigit()):
                have, k = have + text[k], k + 1
            else:
                break
        if need and len(have) == need and have[2:4].isdigit() and not (k < len(text) and text[k].isalnum()) and mod97(have):
            out.append((i, k))
            i = k
        else:
            i += 1
    return out


def test_ibans_in_random_strings_are_those_of_a_scan_from_every_place():
    from inkmill.llm.pii import IBAN_LENGTH

    rng = random.Random(11)

    def iban():
        country = rng.choice(list(IBAN_LENGTH))
        body = "".join(rng.choices("0123456789ABCXYZ", k=IBAN_LENGTH[country] - 4))
        check = next(f"{c:02}" for c in range(2, 99) if mod97(f"{country}{c:02}{body}"))
        whole = country + check + body
        return " ".join(whole[k : k + 4] for k in range(0, len(whole), 4)) if rng.random() < 0.5 else whole

    for text in ("NO93 8601 1117 947 DE89 3704 0044 0532 0130 00", "AB12 0000 0000 000 DE89370400440532013000"):
        assert [(a, b) for k, a, b, _ in spans_of(text) if k == "iban"] == plain_ibans(text) != []
    for _ in range(1500):
        parts = [rng.choice([iban, lambda: "".join(rng.choices("AB12 D", k=rng.randrange(9))), lambda: rng.choice(["NO93", "DE", "x", ",", "  ", "DE89 3704"])])() for _ in range(rng.randrange(1, 6))]
        text = rng.choice([" ", "", ", "]).join(parts)
        assert [(a, b) for k, a, b, _ in spans_of(text) if k == "iban"] == plain_ibans(text), repr(text)


def test_base_counts_equal_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.01"
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn_ = f"list_sum(list_transform(range(1, length({digits}) + 1), lambda i: case when i % 2 = 1 then {digits}[-i]::int else 2 * {digits}[-i]::int - 9 * ({digits}[-i]::int > 4)::int end)) % 10 = 0"
    want = duckdb.sql(rf"""with t as (select doc_id, coalesce(text, '') as t from '{sf}/documents.parquet')
    select doc_id, len(regexp_extract_all(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+')) as n_email,
     len(list_filter(regexp_extract_all(t, '[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)'), lambda m: len(list_filter(string_split(m, '.'), lambda p: length(ltrim(p, '0')) > 3 or coalesce(try_cast(p as int), 0) > 255)) = 0)) as n_ip,
     len(list_filter(regexp_extract_all(t, '[0-9](?:[\x20-]?[0-9])+'), lambda m: length({digits}) between 16 and 19 and {luhn_})) as n_card,
     len(list_filter(regexp_extract_all(t, '\+[0-9][\x20().0-9-]+[0-9]'), lambda m: length({digits}) between 8 and 15)) as n_phone from t""").fetchall()
    got = [(r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in op3_pii(spark, sf).collect()]
    assert sorted(got) == sorted(want) and all(sum(r[k] for r in got) > 5 for k in range(1, 5))
