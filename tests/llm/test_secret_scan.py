import base64
import hashlib
import json
import random
import re
import time

from helpers import empty, odd_documents

from nearkin.llm import secret_scan as S


def brute(text):
    """Base spans by searching the whole text with each expression."""
    assign = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
                        r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def test_base_spans_are_those_of_a_full_search():
    rng = random.Random(3)
    parts = ["password", "passwd", "Secret", "TOKEN", "api_key", "apikey", "=", ":", " ", "  ", "'", '"', "abcdef", "abc", "AKIA", "AKIA" + "Z9" * 9,
             "é", "K", "ſ", "İ", "\n", "0" * 24, "deadbeef", "token=token: x", "-", "\t"]
    words = S.automaton()
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert [s for s in S.spans_of(text, words) if s[1] < 3] == brute(text), text


def test_checksums_decide():
    words = S.automaton()
    body = "A1b2C3d4E5" * 3
    good, bad = f"ghp_{body}{S.base62_crc32(body)}", f"ghp_{body}000000"
    assert S.written(S.spans_of(f"see {good}.", words)) == f"github:4:{4 + len(good)}"
    assert S.spans_of(bad, words) == []
    assert S.written(S.spans_of(f"npm_{body}{S.base62_crc32(body)}", words)) == "npm:0:40"
    coded = [base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=") for x in ({"alg": "HS256"}, {"sub": 1})]
    assert S.written(S.spans_of(".".join([*coded, "sig-x"]), words)).startswith("jwt:0:")
    assert S.spans_of(".".join([coded[1], coded[1], "sig"]), words) == []
    pem = "-----BEGIN RSA PRIVATE KEY-----\nQUJD\n-----END RSA PRIVATE KEY-----"
    assert S.written(S.spans_of(pem, words)) == f"pem:0:{len(pem)}"


def test_redaction_joins_overlaps():
    words = S.automaton()
    text = "keep token=" + "a" * 30 + " tail"
    assert S.redacted(text, S.spans_of(text, words), "[X]") == "keep [X] tail"
    assert S.redacted("plain", [], "[X]") == "plain"


def test_tables(spark):
    rows = odd_documents(spark)
    got = sorted((repr(tuple(r)) for r in S.digests(rows).collect()))
    want = []
    for r in rows.collect():
        spans = brute(r.text or "")
        counts = [sum(k == kind for _, k, _ in spans) for kind in range(3)]
        want.append(repr((r.doc_id, *counts, hashlib.sha256(S.written(spans).encode()).hexdigest(), S.written(spans))))
    assert got == sorted(want)
    assert S.scan(rows).columns == [*rows.columns, "spans_"]
    redacted = S.redact(rows)
    assert redacted.columns == rows.columns
    assert redacted.filter("doc_id = 0").first().text is None
    assert S.digests(empty(spark, "doc_id long, text string")).count() == 0


def test_repeated_keywords_take_linear_time():
    words = S.automaton()
    for piece in ("eyJ", "eyJa.", "eyJa.eyJ", "token=", "token ", "AKIA", "-----BEGIN ", "-----BEGIN PRIVATE KEY-----a", "ghp_", "npm_"):
        start = time.perf_counter()
        S.spans_of(piece * (1_000_000 // len(piece)), words)
        assert time.perf_counter() - start < 5, piece


def test_a_jwt_inside_a_failed_run_is_found_where_the_search_would():
    words = S.automaton()
    header = base64.urlsafe_b64encode(b'{"alg":"HS256"}').decode().rstrip("=")
    token = f"{header}.eyJzdWIiOiIxIn0.c2ln"
    for before in ("eyJ eyJ. ", "eyJeyJ.eyJx ", "eyJa.eyJb, "):
        spans = [s for s in S.spans_of(before + token, words) if S.KINDS[s[1]] == "jwt"]
        assert spans == [(len(before), S.KINDS.index("jwt"), len(before + token))]


def test_keys_with_headers_and_pgp_blocks():
    words = S.automaton()
    for label, body in (("RSA PRIVATE KEY", "\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0A\n\nMIIB+/=\n"), ("PGP PRIVATE KEY BLOCK", "\nVersion: x - y\n\nlQ==\n"),
                        ("PRIVATE KEY", "\nMIIE\n")):
        text = f"see -----BEGIN {label}-----{body}-----END {label}----- end"
        spans = [s for s in S.spans_of(text, words) if S.KINDS[s[1]] == "pem"]
        assert spans == [(4, S.KINDS.index("pem"), len(text) - 4)]
    assert not [s for s in S.spans_of("-----BEGIN PRIVATE KEY-----x-----END RSA PRIVATE KEY-----", words) if S.KINDS[s[1]] == "pem"]
