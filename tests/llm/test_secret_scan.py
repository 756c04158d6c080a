import hashlib
import re

from mailsieve.llm.queries import op10_secrets
from mailsieve.llm.secret_scan import SCOPE, find_parts, mask_secrets, scan_secrets

NAMES = ["password", "passwd", "secret", "token", "apikey", "api_key"]


def word_at(text, i):
    for name in NAMES:
        piece = text[i : i + len(name)]
        if piece.isascii() and piece.lower() == name:
            return i + len(name)
    return None


def value_at(text, i):
    """End of the value after a key word that ends at ``i``, or None; tries what may be absent."""
    for quote in (1, 0):
        j = i
        if quote:
            if text[j : j + 1] not in ('"', "'") or not text[j : j + 1]:
                continue
            j += 1
        while text[j : j + 1] == " ":
            j += 1
        if text[j : j + 1] not in (":", "="):
            continue
        j += 1
        while text[j : j + 1] == " ":
            j += 1
        if text[j : j + 1] in ('"', "'") and text[j : j + 1]:
            j += 1
        start = j
        while j < len(text) and text[j].isascii() and (text[j].isalnum() or text[j] in "+/_.=-"):
            j += 1
        if j > start:
            return start, j
    return None


def plain_base(text):
    spans, i = [], 0
    while i < len(text):
        end = word_at(text, i)
        value = end and value_at(text, end)
        if value:
            if value[1] - value[0] >= 12:
                spans.append(("assign", i, value[1]))
            i = value[1]
        else:
            i += 1
    spans += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    order = ["assign", "access", "hex"]
    return sorted(spans, key=lambda s: (s[1], order.index(s[0])))


def test_query_equals_brute_force(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").collect()
    found = {r.doc_id: r for r in op10_secrets(spark, small).collect()}
    assert len(found) == len(rows)
    for row in rows:
        base = plain_base(row.text)
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        got = found[row.doc_id]
        assert got.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [got.n_assign, got.n_access, got.n_hex] == [
            sum(s[0] == k for s in base) for k in ("assign", "access", "hex")
        ]
        assert set(filter(None, line.split(","))) <= set(got.spans.split(","))


def test_tricky_base_spans():
    for text in [
        "secret: token: abcdefghijklmnop", 'API_KEY"  =  "abcdefghijkl"', "apikey:abcdefghijk", "ToKeN=" + "a" * 12,
        "password=secret=abcdefghijklmnop", "ſecret=abcdefghijklmn", "toKen=abcdefghijklmn", "AKIA" + "Z" * 13,
        "AKIA" + "Z" * 14, "0123456789abcdef0", "0123456789abcde", "tokentoken = abcdefghijklm", "",
    ]:
        assert [p for p in find_parts(text)[0]] == plain_base(text), text


def spans_of(spark, text):
    frame = spark.createDataFrame([(1, text)], "doc_id int, text string")
    return [tuple(s) for s in scan_secrets(frame).first().spans]


def test_weak_parts_need_a_partner_in_scope(spark):
    assert spans_of(spark, "login: alice at https://db.example.com") == []
    assert [s[0] for s in spans_of(spark, "login: alice password=abcdefgh1234")] == ["account", "assign"]
    near = "https://db.example.com" + " " * SCOPE + "x token=abcdefgh1234"
    far = "https://db.example.com" + " " * (SCOPE + 1) + " token=abcdefgh1234"
    assert [s[0] for s in spans_of(spark, near[:22] + near[24:])] == ["endpoint", "assign"]
    assert [s[0] for s in spans_of(spark, far)] == ["assign"]
    assert [s[0] for s in spans_of(spark, "Zx9" * 8 + " bob@mail.example.com")] == ["opaque", "mail"]
    assert spans_of(spark, "Zx9" * 8) == []


def test_linking_equals_brute_force(spark):
    import random

    draw = random.Random(3)
    pieces = ["login: bob", "password=abcdefgh1234", "https://a.example.com/q", "Ab3" * 9, "me@x.example.com", "AKIA" + "Q" * 16]
    texts = ["".join(draw.choice(pieces) + " " + "." * draw.randrange(700) + " " for _ in range(12)) for _ in range(40)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    from mailsieve.llm.secret_scan import NEEDS, ROLES

    for row in scan_secrets(frame).collect():
        strong, weak = find_parts(texts[row.doc_id])
        linked = [
            w for w in weak
            if any(ROLES[p[0]] in NEEDS[ROLES[w[0]]] and p[1] <= w[2] + SCOPE and p[2] >= w[1] - SCOPE for p in strong + weak)
        ]
        assert sorted(map(tuple, row.spans)) == sorted(strong + linked)


def test_odd_rows_and_masking(odd, empty):
    rows = scan_secrets(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.spans == [] for r in rows if r.doc_id in (3, 4, 5))
    masked = mask_secrets(odd)
    assert masked.columns == odd.columns and masked.count() == odd.count()
    texts = {r.doc_id: r.text for r in masked.collect()}
    assert "abcdEFGH1234" not in texts[7] and texts[7] == texts[8]
    assert texts[7].startswith("[account]\n[assign]") and texts[3] is None
    assert texts[15] == "[access] " * 400
    assert scan_secrets(empty).count() == 0 and mask_secrets(empty).count() == 0
