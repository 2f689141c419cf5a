import hashlib
import random
import re

from tablespan.llm import personal
from tests.llm.frames import SMALL, documents, given, written


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits(m):
    return re.sub("[^0-9]", "", m[0])


CHECKS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
]


def expected(text):
    spans = sorted((m.start(), n, kind, m.end()) for n, (kind, p, good) in enumerate(CHECKS) for m in re.finditer(p, text or "") if good(m))
    joined = ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)
    return (*(sum(s[2] == k for s in spans) for k, _, _ in CHECKS), hashlib.sha256(joined.encode()).hexdigest())


def actual(r):
    return (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256)


ODD = [
    None, "", "plain", "a@b.cd_x@y.zz", "a@b.c..d@e.f", "x@y", "é🙂 a.b+c@d-e.fg é", "1.2.3.4.5.6.7.8", "256.1.1.1", "0000255.1.01.000", "1.2.3", "4111 1111-1111 1111",
    "4111111111111112", "4111  1111 1111 1111", "+1 (555) 123-4567", "+1 555", "+1 (555) 123-4567 890 123 45", "++12 3456789012", "1" * 5000, "1." * 9000, "a" * 30000 + "@",
    "a.b-" * 9000, "x@" + "a." * 9000 + "b", "+" + "1 " * 9000, "+1 " * 3000, "4111111111111111 " * 700 + "é a@b.cd" * 300, "@ @@ a@@b.c", "a@b.c@d.e", "  9 4",
]


def odd_rows():
    draw = random.Random(8)
    signs = ["1", "22", "4111111111111111", ".", "@", "+", " ", "-", "a", "b.c", "(", ")", "é", "_", "255", "\n", "0"]
    made = ["".join(draw.choices(signs, k=draw.randint(1, 30))) for _ in range(2000)]
    return list(enumerate([*ODD, *made])) + [(4, ODD[4]), (None, ODD[3])]


def test_base_spans(spark, tmp_path):
    rows = odd_rows()
    result = personal.op8_personal_data(spark, written(tmp_path, documents=documents(spark, rows))).collect()
    texts = dict(rows)
    wrong = [(texts[r.doc_id], r.spans) for r in result if actual(r) != expected(texts[r.doc_id])]
    assert not wrong[:3]
    assert len(result) == len(rows)


def test_given_documents(spark):
    texts = {d["doc_id"]: d["text"] for d in given("documents")}
    result = personal.op8_personal_data(spark, SMALL).collect()
    assert len(result) == len(texts) and all(actual(r) == expected(texts[r.doc_id]) for r in result)


def test_contexts_find_unseen_identifiers(spark, tmp_path):
    rows = [(i, f"Some words, then you may contact me: user{i}@mail.com today") for i in range(12)]
    rows += [(100, "Please contact me: user_at_77612 today"), (101, "later user_at_77612 came back"), (102, "the year was 1999 and 2000"), (103, "")]
    folder = written(tmp_path, documents=documents(spark, rows))
    spans = {r.doc_id: r.spans for r in personal.op8_personal_data(spark, folder).collect()}
    assert spans[100] == "context:19:32" and spans[101] == "context:6:19"
    assert spans[102] == spans[103] == "" and spans[3].startswith("email:") and "context" not in spans[3]


def test_spans_with_blanks_are_seeds(spark, tmp_path):
    rows = [(i, f"Some words, please call desk: +1 (511) 555-68{i} today") for i in range(10, 20)]
    rows += [(i, f"then she paid card: 4111 1111 1111 {n} today") for i, n in zip(range(20, 25), ("1111", "1129", "1137", "1145", "1152"), strict=True)]
    rows += [(i, f"a sum of +{i}.5 points") for i in range(30, 40)]
    rows += [(100, "please call desk: ext-77612 today"), (101, "later ext-77612,a@b.cd came"), (102, "then she paid card: acc-90210"), (103, "a sum of 123456 points")]
    folder = written(tmp_path, documents=documents(spark, rows))
    spans = {r.doc_id: r.spans for r in personal.op8_personal_data(spark, folder).collect()}
    assert spans[100] == "context:18:27" and spans[101] == "context:6:15,email:16:22" and spans[102] == "context:20:29"
    assert spans[103] == spans[30] == "" and spans[10] == "phone:30:47" and spans[20] == "card:20:39"


def test_contexts_with_digits_and_long_words(spark, tmp_path):
    long = "w" * 200
    rows = [(i, f"member id A-{i} pin mail{i}@a.bc") for i in range(12)] + [(i, f"{long} {long} 10.0.0.{i} end") for i in range(20, 32)]
    rows += [(i, f"from a{i}@b.cd, to +1 511 555 68{i}") for i in range(40, 52)]
    rows += [(100, "  member id A-17 pin 99887"), (101, f"{long}x {long} 55443"), (102, f"{long} {long}\n55667"), (103, "from new@b.cd, to ext-4321")]
    folder = written(tmp_path, documents=documents(spark, rows))
    spans = {r.doc_id: r.spans for r in personal.op8_personal_data(spark, folder).collect()}
    assert spans[100] == "context:21:26" and spans[101] == "" and spans[102] == "context:402:407"
    assert spans[103] == "email:5:13,context:18:26"


def test_places_are_kept_in_long_texts(spark):
    text = " " + "".join(f"w{i}  é🙂 a{i}@b.cd;x{i} " for i in range(700))
    found = personal.base_spans(documents(spark, [(1, text)])).first()
    assert all(text[m.start : m.stop].lower() == m.instance for m in found.mentions) and len(found.mentions) == 2100
    assert [m.pattern for m in found.mentions[:4]] == ["", "w0 é🙂", "w0 é🙂", "é🙂 \uFDD0;x0"] and found.mentions[-1].pattern == "w0 é🙂"


def test_discovered_instances_make_patterns(spark, tmp_path):
    found = [f"id-7760{i}" for i in range(4)]
    rows = [(i, f"you may contact me: user{i}@mail.com today") for i in range(12)] + [(20 + i, f"you may contact me: {x} today") for i, x in enumerate(found)]
    chain = [*found, "id-55001"], ["id-55001", "id-55002", *found[:3]], ["id-55001", "id-55002", "id-55003", found[0]]
    rows += [(30 + 10 * n + i, f"one hop{'abc'[n]} {x} more") for n, xs in enumerate(chain) for i, x in enumerate(xs)]
    rows += [(90 + i, f"in year {1990 + i} again") for i in range(5)]
    folder = written(tmp_path, documents=documents(spark, rows))
    spans = {r.doc_id: r.spans for r in personal.op8_personal_data(spark, folder).collect()}
    assert spans[20] == "context:20:28" and spans[34] == spans[41] == spans[52] == "context:9:17"
    assert not any(spans[90 + i] for i in range(5))


def test_no_documents(spark, tmp_path):
    assert personal.op8_personal_data(spark, written(tmp_path, documents=documents(spark, []))).count() == 0
