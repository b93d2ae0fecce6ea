import random
import re

from smogline.llm import secrets
from tests.llm.helpers import AWKWARD, frame

TABLE = "/root/testdata/sf0.1"


def planted(n, rng):
    hexa = lambda k: "".join(rng.choice("0123456789abcdef") for _ in range(k))
    words = lambda k: " ".join(rng.choice(["some", "plain", "words", "stand", "here"]) for _ in range(k))
    kind = n % 4
    mid = {0: f"password={hexa(18)}", 1: f'token = "{hexa(40)}"', 2: "plain" * rng.randrange(4, 7),
           3: "AKIA" + "".join(rng.choice("ABCDEFGHIJ0123456789") for _ in range(16))}[kind]
    return f"{words(8)} {mid} {words(5)}", kind != 2


def test_forest_tells_planted_findings(spark):
    rng = random.Random(8)
    made = [planted(n, rng) for n in range(300)]
    rows = [(n, t) for n, (t, _) in enumerate(made)]
    got = secrets.scan(frame(spark, rows)).collect()
    assert len(got) == 300
    assert sum(r.secret == made[r.doc_id][1] for r in got) >= 297
    labels = spark.createDataFrame([(r.doc_id, r.start, int(made[r.doc_id][1])) for r in got if r.doc_id % 3], "doc_id long, start int, secret int")
    held = [r for r in secrets.scan(frame(spark, rows), findings=labels).collect() if r.doc_id % 3 == 0]
    assert sum(r.secret == made[r.doc_id][1] for r in held) >= 98


def test_short_and_odd_credentials_are_candidates(spark):
    texts = {"set password=abc123xyz now": "abc123xyz", 'the db_password: "p.4!@$ x", then': "p.4!@$ x", "Server=h;Password=a$b;9!;User=me;": "a$b;9!",
             "postgres://me:s3c!r.t@host:5432/db": "s3c!r.t", '{"apiKey":"k9"}': "k9", "secret = ünï1.": "ünï1", "https://host:80/a and monkey=1": None,
             "token: password: q7": "q7", "a key=1": "1"}
    assert {t: [t[a:b] for a, b, _ in secrets.spans(t)][-1:] for t in texts} == {t: [c] if c else [] for t, c in texts.items()}
    rng = random.Random(9)
    rows = [(n, planted(n, rng)[0]) for n in range(200)]
    rows += [(1000 + n, f"some plain words password={rng.choice('abcxyz')}{rng.randrange(100, 999)}.{rng.choice('!@$')}k stand here") for n in range(40)]
    got = [r for r in secrets.scan(frame(spark, rows)).collect() if r.doc_id >= 1000]
    assert len(got) == 40 and sum(r.secret for r in got) >= 38 and all(len(r.candidate) == 7 for r in got)


def test_awkward_rows(spark):
    got = secrets.scan(frame(spark, AWKWARD + [(None, "a token Zm9vYmFyMTIzNDU2Nzg= here")]))
    rows = {(r.doc_id, r.candidate[:30]) for r in got.collect()}
    assert rows == {(7, "x" * 30), (None, "Zm9vYmFyMTIzNDU2Nzg=")}
    assert all(r.secret and r.probability is None for r in got.collect())
    assert secrets.scan(frame(spark, [])).count() == 0


def test_shares_are_over_all_findings(spark, monkeypatch):
    rng = random.Random(10)
    made = [planted(n, rng) for n in range(400)]
    seen, rates = [], secrets._rates

    def spy(findings, column, whole):
        out = rates(findings, column, whole)
        seen.append((column, whole, findings.count(), {r[0]: r[1] for r in out.collect()}))
        return out

    monkeypatch.setattr(secrets, "_rates", spy)
    got = secrets.scan(frame(spark, [(n, t) for n, (t, _) in enumerate(made)]), fit_rows=40).collect()
    assert sum(r.secret == made[r.doc_id][1] for r in got) >= 390
    whole = sum(s for _, s in made) / 400
    for column, share, n, table in seen:
        assert share == whole and n == 400
        if column == "path":
            for path in (None, "s0", "s1"):
                mine = [s for k, (_, s) in enumerate(made) if (f"s{k % 2}" if k % 5 else None) == path]
                assert abs(table[path] - (sum(mine) + 5 * whole) / (len(mine) + 5)) < 1e-12


def test_every_formatted_secret_of_the_table_is_kept(spark):
    got = secrets.op8_secrets(spark, TABLE).collect()
    keys = {(r.doc_id, r.candidate) for r in got if r.secret}
    want = {(r.doc_id, m) for r in spark.read.parquet(f"{TABLE}/documents.parquet").select("doc_id", "text").collect()
            for m in re.findall(r"\bAKIA[0-9A-Z]{16}\b|(?<=password=)[0-9a-f]{18}\b|(?<=token = \")[0-9a-f]{40}\b", r.text)}
    assert len(want) > 50 and len(want & keys) >= 0.98 * len(want)
    plain = [r for r in got if r.candidate.isalpha() and r.candidate.islower()]
    assert sum(not r.secret for r in plain) >= 0.99 * len(plain)


def test_values_of_every_kind():
    for text, values in [
            ("password=abc123xyz, next", ["abc123xyz"]), ('token = "a b\\"c"', ['a b\\"c']), ("secret: 'x y' z", ["x y"]),
            ("key=a&token=b", ["a", "b"]), ("pwd='open", ["open"]), ("token=`", []), ("token=...", []), ("key=a;b c", ["a;b"]),
            ("token=a.b.) end", ["a.b"]), ("secret=token=abc", ["token=abc"]), ('token=ab"cd', ["ab"])]:
        assert [text[a:b] for a, b, assigned in secrets.spans(text) if assigned] == values, text


def test_long_texts_are_read_once():
    import time

    for text in ("token=" * 170_000, "password=" + "." * 1_000_000, "key=a&" * 160_000, "token='" * 150_000,
                 "token=;" * 150_000, "://a:" * 200_000, "x" * 1_000_000):
        began = time.perf_counter()
        found = secrets.spans(text)
        assert time.perf_counter() - began < 8
        assert sum(b - a for a, b, _ in found) <= 2 * len(text)
