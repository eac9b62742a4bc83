import random

from helpers import docs_of, prose
from weirflow.llm.secrets import candidates, findings, weak_label, with_coverage, with_features

PLAIN = {
    "password = hunter2024": "hunter2024",
    "password: Sup3r$ecret!Pass9": "Sup3r$ecret!Pass9",
    "db_password=correcthorsebatterystaple": "correcthorsebatterystaple",
    'secret: "two words, and more"': "two words, and more",
    "api_key => 'a.b.c.d~e'": "a.b.c.d~e",
    "(pwd=x7!x7!x).": "x7!x7!x",
    "https://a.example/v?access_token=ab.cd~ef&user=someone": "ab.cd~ef",
    "Authorization: Bearer abc.def.ghi": "abc.def.ghi",
    '{"passwd":"Zz-zz Zz"}': "Zz-zz Zz",
    "token='unclosed12 and so on": "unclosed12",
}


def test_values_of_secret_names_are_candidates(spark):
    found = candidates(docs_of(spark, [f"it was {t} here" for t in PLAIN])).collect()
    for k, (text, value) in enumerate(PLAIN.items()):
        assert value in {r.candidate for r in found if r.id == k}, text
    assert candidates(docs_of(spark, ["no password, no token: it is", "a secret = x", "value = longenoughword", "passwords are words"])).count() == 0


def test_a_value_of_any_length_is_whole(spark):
    long = "Ab!" * 40_000
    (row,) = candidates(docs_of(spark, [f'password = "{long}" end'])).collect()
    assert row.candidate == long and row.after == '" end'


def test_short_and_wordlike_secrets_are_found_and_others_go(spark):
    rng = random.Random(5)
    texts, want = [], {}
    for k in range(210):
        word = "".join(rng.choice("abcdefghijklmnop") for _ in range(9))
        middle = [f"password = {word[:6]}{k + 1000}", f'db_password="{word}"', f"secret: {word[:4]}$!{word[4:]}X", f"commit {rng.getrandbits(160):040x}", f"/usr/share/{word}12345/x.txt", f"order {rng.getrandbits(60)}", "no secret: winter"][k % 7]
        texts.append(f"{prose(rng, 12)} winter {middle} winter {prose(rng, 12)}")
        want[k] = k % 7 < 3
    by_doc = {}
    for r in findings(docs_of(spark, texts)).collect():
        by_doc[r.doc_id] = by_doc.get(r.doc_id, False) or r.is_secret
    wrong = [k for k, y in want.items() if by_doc.get(k, False) != y]
    assert len(wrong) <= 2, wrong


def test_base64_keys_with_slashes_and_tokens_in_urls_are_secrets(spark):
    rng = random.Random(6)
    run = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    texts, want = [], {}
    for k in range(200):
        key = f"{run(letters, 13)}/{run(letters, 7)}/{run(letters, 18)}"
        middle = [f"aws_secret_access_key = {key}", f"https://api.x.com/v1?token={run('0123456789abcdef', 32)}", f"https://x.com/static/{run('0123456789abcdef', 32)}.js", f"/var/lib/app{k}/cache/{run('0123456789abcdef', 32)}", f"commit {run('0123456789abcdef', 40)}"][k % 5]
        texts.append(f"{prose(rng, 12)} {middle} {prose(rng, 12)}")
        want[k] = k % 5 < 2
    rows = with_features(with_coverage(candidates(docs_of(spark, texts))))
    labels = {}
    for r in rows.withColumn("label", weak_label(rows)).collect():
        labels.setdefault(r.id, []).append(r.label)
    assert all((1 in labels[k]) == y for k, y in want.items())
    assert {r.path for r in rows.filter("id % 5 < 2 and assigned = 1").collect()} == {0.0}
    assert {r.path for r in rows.filter("id % 5 = 2 or id % 5 = 3").collect()} == {1.0}
    by_doc = {}
    for r in findings(docs_of(spark, texts)).collect():
        by_doc[r.doc_id] = by_doc.get(r.doc_id, False) or r.is_secret
    wrong = [k for k, y in want.items() if by_doc.get(k, False) != y]
    assert len(wrong) <= 2, wrong
