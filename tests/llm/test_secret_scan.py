import random
import string

from loomline.llm import secret_scan
from tests.llm.data import frame, odd_rows, row, words


def corpus():
    rng, rows, secrets = random.Random(4), [], {}
    for i in range(240):
        text = words(rng.randint(10, 80), i)
        at = rng.randint(3, len(text))
        kind = i % 6
        value = "".join(rng.choices("0123456789abcdef", k=40))
        if kind == 0:
            text[at:at] = ["token", "=", f'"{value}"']
            secrets[i] = value
        elif kind == 1:
            value = "AKIA" + "".join(rng.choices(string.ascii_uppercase + "234567", k=16))
            text[at:at] = [value + ","]
            secrets[i] = value
        elif kind == 2:
            text[at:at] = [f"password={value[:18]}"]
            secrets[i] = value[:18]
        elif kind == 3:
            text[at:at] = [f"{text[0]}.{i}@mail{i % 9}.example.com", "4041894974608795", "10.20.30.140"]
        elif kind == 4:
            text[at:at] = [f"https://www.{text[1]}.example.com/{text[2]}/{i}.html"]
        rows.append(row(i, " ".join(text)))
    return rows, secrets


def test_secrets_are_found_and_the_rest_left(spark):
    rows, secrets = corpus()
    got = secret_scan.scan(frame(spark, rows + odd_rows(5000))).collect()
    assert {r.doc_id: r.value for r in got if r.score >= secret_scan.LIMIT} == secrets
    assert {r.doc_id % 6 for r in got if r.score < secret_scan.LIMIT} >= {3}
    text = {r[0]: r[1].split() for r in rows}
    assert all(text[r.doc_id][r.position] == r.word for r in got if r.doc_id < 5000)


def test_given_labels_teach(spark):
    """A forest that learned that hex codes are harmless lets them pass."""
    rows, secrets = corpus()
    docs = frame(spark, rows)
    marked = secret_scan.findings(docs).withColumn("label", secret_scan.F.col("value").startswith("AKIA").cast("double"))
    got = secret_scan.scan(docs, secret_scan.checkpointed(marked)).where("score >= 0.5").collect()
    assert {r.doc_id for r in got} == {i for i in secrets if i % 6 == 1}


def test_one_sided_labels_decide_alone(spark):
    rows = [row(1, "mail a.b.12@mail3.example.com now"), row(2, "call 4041894974608795 or 10.20.30.140")]
    assert {r.score for r in secret_scan.scan(frame(spark, rows)).collect()} == {0.0}
    none = secret_scan.marked_by_format(secret_scan.findings(frame(spark, [])))
    assert {r.score for r in secret_scan.scan(frame(spark, rows), secret_scan.checkpointed(none)).collect()} == {1.0}


def test_masking_keeps_rows_and_columns(spark):
    rows, secrets = corpus()
    rows = rows + odd_rows(5000)
    masked = secret_scan.mask_secrets(frame(spark, rows))
    assert masked.columns == frame(spark, rows).columns
    got = masked.collect()
    assert len(got) == len(rows)
    before = {r[0]: r[1] for r in rows}
    for r in got:
        expected = before[r.doc_id]
        if r.doc_id in secrets:
            expected = expected.replace(secrets[r.doc_id], secret_scan.MASK)
        assert r.text == expected


def test_empty_and_clean_tables(spark):
    assert secret_scan.scan(frame(spark, [])).collect() == []
    assert secret_scan.scan(frame(spark, odd_rows(0)[:4])).collect() == []
    clean = [row(1, "nothing here"), row(2, None)]
    assert sorted(r.text or "" for r in secret_scan.mask_secrets(frame(spark, clean)).collect()) == ["", "nothing here"]


def test_every_secret_of_a_word_spaced_values_keys_and_rows_without_id(spark):
    rows, _ = corpus()
    rng = random.Random(9)
    aws = lambda: "AKIA" + "".join(rng.choices(string.ascii_uppercase + "234567", k=16))
    a, b, c, d = (aws() for _ in range(4))
    body = "\n".join("".join(rng.choices(string.ascii_letters + string.digits, k=64)) for _ in range(4)) + "\nQ=="
    key = f"-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,A1\n\n{body}\n-----END RSA PRIVATE KEY-----"
    rows += [
        row(1000, f'see {{"api_key":"{a}","password":"hunter2xyz9","user":"bob"}} here'),
        row(1001, f"keys {b},{c} end"),
        row(1002, "login password = hunter2x now"),
        row(1003, f"before\n{key}\nafter all"),
        row(None, f"no id {d} at all"),
    ]
    got = secret_scan.findings(frame(spark, rows)).collect()
    values = lambda i: {r.value for r in got if r.doc_id == i}
    assert values(1000) == {a, "hunter2xyz9"} and values(1001) == {b, c} and values(1002) == {"hunter2x"}
    assert values(1003) == {key} and values(None) == {d}
    text = {r.doc_id: r.text for r in secret_scan.mask_secrets(frame(spark, rows)).where("doc_id >= 1000 or doc_id is null").collect()}
    assert text[1000] == 'see {"api_key":"[SECRET]","password":"[SECRET]","user":"bob"} here'
    assert text[1001] == "keys [SECRET],[SECRET] end" and text[1003] == "before\n[SECRET]\nafter all"
    assert text[1002] == "login password = [SECRET] now" and text[None] == "no id [SECRET] at all"
