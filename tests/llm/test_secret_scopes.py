"""Weak candidates of any length, in either case and after a prefix, linked within their paragraph at any distance."""

from riskloom.llm import secret_links

KEY = "Ab1+" * 21 + "xY=="
URL = "https://store.example.com/blob?sig=" + "aB3%2F" * 100


def spans(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [s.split(":")[0] for s in r.spans.split(",") if s] for r in secret_links.secrets(docs).collect()}
    return found, {r.doc_id: r.text for r in secret_links.redacted(docs).collect()}


def test_long_values_are_found_and_cut_whole(spark):
    texts = [f"AccountName={'n' * 90} AccountKey={KEY} at {URL} end", f"account: abc key {KEY} end", f"user: abc password=hunter22 see {URL} end",
             f"plain {KEY} alone"]
    found, clean = spans(spark, texts)
    assert found[0] == ["ident", "part", "endpoint"] and found[1] == ["ident", "part"] and found[2] == ["ident", "assign", "endpoint"]
    assert clean[0].split() == ["[secret]", "AccountKey=[secret]", "at", "[secret]", "end"]
    assert clean[2].endswith("see [secret] end") and found[3] == [] and clean[3] == texts[3]


def test_names_in_either_case_and_after_a_prefix(spark):
    names = ["Username: x_1", "CLIENT_ID=x_1", "DB_USER=x_1", "LOGIN = 'x_1"]
    found, _ = spans(spark, [f"{n}\nkey {KEY}" for n in names])
    assert all(found[i] == ["ident", "part"] for i in range(len(names)))


def test_distance_does_not_matter_within_a_paragraph(spark):
    far = "word " * 1000
    found, _ = spans(spark, [f"user: alice {far} key {KEY} {far} https://db.example.com/x", f"user: alice {far}\n\n key {KEY}"])
    assert found == {0: ["ident", "part", "endpoint"], 1: []}
