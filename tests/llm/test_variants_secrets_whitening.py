"""Spelling variants, secrets and whitening against brute force, plain readings of the contract and numpy."""

import base64
import hashlib
import json
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from paritas.llm.secret_scan import KINDS, find_secrets, secret_digests, spans
from paritas.llm.spelling import corpus_words, document_variants, spelling_variants
from paritas.llm.whitening import feast, inertia, intervals, tridiagonal, whiten

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# Spelling variants


def brute_words(rows, slips=97, length=5, count=3):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if slips and h % slips == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= length and n >= count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(words):
    near = defaultdict(list)
    for a in words:
        for b in words:
            if abs(len(a) - len(b)) < 2 and a != b and one_edit(a, b):
                near[a].append(b)
    form = {}
    for a, others in near.items():
        best = min(others, key=lambda b: (-words[b], b))
        if words[best] >= 2 * words[a]:
            form[a] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, n, len(near[w]), form.get(w), words[form[w]] if w in form else None, root(w)) for w, n in words.items()}


def as_set(df):
    got = [tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_variants_of_odd_documents(odd, odd_rows, clashing, empty):
    want = brute_variants(brute_words([r[:2] for r in odd_rows]))
    assert want and as_set(document_variants(odd)) == want
    assert as_set(document_variants(clashing)) == want
    assert document_variants(empty).count() == 0


@pytest.mark.parametrize("most", [0, 5, 1 << 12])
def test_variants_where_many_words_share_a_reduced_word(spark, most):
    # letters of one symbol: every word of a length has the same reduced word
    symbol = lambda c: ((ord(c) * 0x9E3779B1) >> 7) % 8
    one = [c for c in "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ" if symbol(c) == symbol("e")]
    assert len(one) > 4
    words = {}
    for i in range(400):
        word = "".join(one[(i * 7 + i // len(one) ** k) % len(one)] for k in range(5 + i % 2))
        words[word] = 3 + i * i % 89
    words |= {"bacon": 5, "beacon": 9, "bacons": 12, "baçon": 2, "x" * 3000: 4, "x" * 3001: 9, "y": 1, "": 3}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(4)
    assert as_set(spelling_variants(df, most)) == brute_variants(words)


def test_forms_lead_to_the_last(spark):
    words = {"a" * 5 + "b" * k: 2 ** (k + 1) for k in range(40)}
    got = {r.word: r.root for r in spelling_variants(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    assert set(got.values()) == {"a" * 5 + "b" * 39}


def test_ties_go_to_the_first_in_code_point_order(spark):
    words = {"stoned": 3, "stone": 6, "stoner": 6, "àbcde": 3, "zbcde": 6, "ÿbcde": 6}
    got = {r.word: r.form for r in spelling_variants(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    assert got["stoned"] == "stone" and got["àbcde"] == "zbcde"


def test_words_cut_between_slices(spark, monkeypatch):
    from paritas.llm import spelling

    monkeypatch.setattr(spelling, "_SLICE", 7)
    rows = [(1, "cafés Cafés 中文cafés ×÷abc"), (2, ""), (3, None), (4, "Àbcdefghijklmnop " * 3), (None, "longer words here " * 4)]
    batch = spark.createDataFrame(rows, "doc_id long, text string").toArrow().to_batches()
    found = Counter()
    for part in spelling._counter(3, 2)(iter(batch)):
        for word, n in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            found[word] += n
    assert found == brute_words(rows, 3, 2, 1)


def test_words_without_slips(odd, odd_rows):
    got = {r.word: r.n for r in corpus_words(odd).collect()}
    assert got == brute_words([r[:2] for r in odd_rows], 0)


# Secrets


def size(n):
    return bytes([n]) if n < 128 else (lambda b: bytes([0x80 | len(b)]) + b)(n.to_bytes((n.bit_length() + 7) // 8, "big"))


def der(tag, *parts):
    return bytes([tag]) + size(len(b"".join(parts))) + b"".join(parts)


def integer(x):
    return der(2, x.to_bytes(x.bit_length() // 8 + 1, "big"))


def text_field(b):
    return len(b).to_bytes(4, "big") + b


P, Q = 2**521 - 1, 2**607 - 1
RSA = der(0x30, *map(integer, (0, P * Q, 65537, 3**600, P, Q, 3, 5, 7)))
NAME = der(0x30, der(6, bytes.fromhex("2a864886f70d010101")), der(5))
PKCS8 = der(0x30, integer(0), NAME, der(4, RSA))
ED = der(0x30, integer(0), der(0x30, der(6, bytes.fromhex("2b6570"))), der(4, der(4, bytes(range(32)))))
LOCKED = der(0x30, der(0x30, der(6, bytes.fromhex("2a864886f70d01050d")), der(0x30, der(4, b"salt" * 2))), der(4, bytes(64)))
EC = der(0x30, integer(1), der(4, bytes(range(32))), der(0xA0, der(6, bytes.fromhex("2a8648ce3d030107"))))
PUBLIC = der(0x30, NAME, der(3, b"\0", der(0x30, integer(P * Q), integer(3))))
SSH = b"openssh-key-v1\0" + text_field(b"none") * 2 + text_field(b"") + (1).to_bytes(4, "big") + text_field(b"k" * 51) + text_field(b"abcd" * 2 + b"z" * 120)
KEYS = {"rsa": RSA, "pkcs8": PKCS8, "ec": EC, "openssh": SSH}


def lines(key, end, width=64):
    text = base64.b64encode(key).decode()
    return end.join(text[i : i + width] for i in range(0, len(text), width))


def token(header, body, signature):
    part = lambda b: base64.urlsafe_b64encode(b).rstrip(b"=").decode()
    return ".".join((part(json.dumps(header).encode()), part(json.dumps(body).encode()), part(signature)))


def named(text):
    return [(KINDS[k], text[a:b]) for a, b, k in spans(text.encode()) if k > 2]


@pytest.mark.parametrize("kind", KEYS)
@pytest.mark.parametrize("form", ["{0}", "é key: {0} end", "-----BEGIN-----\n{1}\n-----END-----", 'k="{2}\\n"', "中\r\n  {3}\r\nwords after"])
def test_keys_are_found_whole(kind, form):
    key = KEYS[kind]
    shapes = [lines(key, ""), lines(key, "\n"), lines(key, "\\n"), lines(key, "\r\n  ")]
    text = form.format(*shapes)
    assert named(text) == [(kind, next(s for s in shapes if s in text))]


def test_other_key_encodings():
    assert named("x " + lines(ED, "")) == [("pkcs8", lines(ED, ""))]
    assert named("x " + lines(LOCKED, "\n")) == [("pkcs8", lines(LOCKED, "\n"))]
    assert named(f"h={RSA.hex()};")[0] == ("rsa", RSA.hex()) and named(f"h={EC.hex().upper()};")[0] == ("ec", EC.hex().upper())
    both = lines(RSA + b"", "\n") + "\n" + lines(EC, "\n")
    if not base64.b64encode(RSA).endswith(b"="):
        assert [k for k, _ in named(both)] == ["rsa", "ec"]


def test_what_does_not_nest_is_no_key():
    text = base64.b64encode(RSA).decode()
    wrong = bytearray(RSA)
    wrong[40] ^= 1  # the modulus is no longer the product
    for bad in (text[:-8], "A" + text, text[4:], lines(PUBLIC, ""), lines(bytes(wrong), ""), RSA.hex()[:-2], "30" + RSA.hex(), lines(SSH[:-1], ""), lines(SSH.replace(b"abcdabcd", b"abcdabce"), "")):
        assert not named(f"a {bad} z"), bad[:40]


def test_signed_tokens():
    good = token({"alg": "HS256", "typ": "JWT"}, {"sub": "1"}, b"s" * 32)
    assert named(f"t {good} t") == [("jwt", good)] and named(f"({token({'alg': 'RS256'}, {}, b's' * 256)})")
    for header, body, signature in (({"typ": "JWT"}, {}, b"s" * 32), ({"alg": "HS256"}, {}, b"s" * 31), ({"alg": "none"}, {}, b""), ({"alg": 7}, {}, b"s" * 32)):
        assert not named(token(header, body, signature))
    assert not named(token([1], {}, b"s" * 32)) and not named("eyJhbGciOi.eyJzdWIi.abc")


def plain_base(text):
    """The contract read as it stands."""
    out = []
    for m in re.finditer(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for k, (kind, pattern, least) in enumerate((("access", "AKIA[A-Z0-9]+", 16), ("hex", "[0-9a-f]+", 32)), 1):
        out += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return [s for *_, s in sorted(out)]


def test_base_spans_by_the_contract(spark, odd_rows):
    rows = [r[:2] for r in odd_rows]
    rows += [(900, 'Paſſword=12345678 PASSWORD: "abcdefgh" paé api_key=short token = pw:secret=abcdefghij')]
    rows += [(901, "toKen=12345678 ApiKey='x'" + "AKIA" * 5 + " AKIAAKIA12345678z " + "f" * 31 + " " + "0f" * 16 + "g" + "ab" * 40)]
    rows += [(902, "password: token = abcdefghij password=secret=12345678"), (903, "token:\n12345678 token=\x20" + lines(RSA, "\n")), (904, "secret" * 2000 + "=" + "a" * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = Counter(tuple(r) for r in secret_digests(df).collect())
    want = Counter()
    for i, text in rows:
        base = plain_base(text or "")
        more = [(a, k, f"{KINDS[k]}:{a}:{b}") for a, b, k in spans((text or "").encode()) if k > 2]
        every = sorted([(int(s.split(":")[1]), KINDS.index(s.split(":")[0]), s) for s in base] + more)
        n = Counter(s.split(":")[0] for s in base)
        want[i, n["assign"], n["access"], n["hex"], hashlib.sha256(",".join(base).encode()).hexdigest(), ",".join(s for *_, s in every)] += 1
    assert got == want


def test_scan_of_clashing_columns_and_empty_tables(clashing, empty, odd):
    assert find_secrets(empty).count() == 0 and secret_digests(empty).columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    assert Counter(map(str, find_secrets(clashing).collect())) == Counter(map(str, find_secrets(odd).collect()))


def test_scan_is_linear_in_hostile_texts():
    import time

    for text in (b"MIICXQIBAAKB\n" * 80000, b"eyJ." * 250000, b"30820" * 200000, base64.b64encode(b"openssh-key-v1\0" + text_field(b"none")) + b"\n" * 1):
        start = time.perf_counter()
        spans(text * (1 if len(text) > 1000 else 30000))
        assert time.perf_counter() - start < 5


# Whitening


def by_numpy(vectors, k=4):
    """Fit list, deviations, projections (sign free) and shares of one length of vector."""
    x = np.floor(256 * np.array(vectors, float))
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    v = (fit - s / n).T @ (fit - s / n) / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = int((values[:k] > 1e-9 * values[0]).sum()) if values[0] > 0 else 0
    deviations = [sum((n * int(c) - int(t)) ** 2 for c, t in zip(row, s)) for row in x]
    return n, deviations, (x - s / n) @ vectors[:, :k] / np.sqrt(values[:k]), values[:k] / np.trace(v) if k else []


def sample(count, d, seed=3):
    rng = np.random.default_rng(seed)
    return (rng.standard_normal((count, d)) * np.linspace(1, 2, d)).astype(np.float32).tolist()


def test_whitening_equals_numpy(spark):
    rows = [(i, v, i) for i, v in enumerate(sample(300, 12))]
    rows += [(i, rows[0][1], 0) for i in range(300, 500)] + [(None, rows[1][1], None), (7, rows[2][1], 1)]  # copies count once
    odd = [(900, None, 1), (901, [1.0, None] * 6, 1), (902, [math.nan] * 12, 1), (903, [math.inf] + [0.0] * 11, 1), (904, [], 1)]
    schema = "vec_id long, embedding array<float>, n long"
    got = whiten(spark.createDataFrame(rows + odd, schema).repartition(5)).collect()
    n, deviations, want, shares = by_numpy([r[1] for r in rows])
    assert len(got) == 4 * len(rows) and {r.n for r in got} == {n} == {300}
    assert all(r.identity_error < 1e-10 for r in got)
    for c in range(4):
        mine = sorted(((r.vec_id is None, r.vec_id, r.deviation, r.whitened) for r in got if r.component == c + 1), key=str)
        theirs = sorted(((r[0] is None, r[0], d, float(w[c])) for r, d, w in zip(rows, deviations, want)), key=str)
        assert [m[:3] for m in mine] == [t[:3] for t in theirs]
        # rows of a key may be in either order: compare as multisets of rounded numbers, with one sign
        sign = 1 if np.isclose(sum(m[3] * t[3] for m, t in zip(mine, theirs)), abs(sum(m[3] * t[3] for m, t in zip(mine, theirs)))) else -1
        assert np.allclose(sorted(sign * m[3] for m in mine), sorted(t[3] for t in theirs), atol=1e-9)
        assert all(math.isclose(r.explained, shares[c], rel_tol=1e-9) for r in got if r.component == c + 1)


def test_whitening_of_few_and_flat_vectors(spark):
    schema = "vec_id long, embedding array<double>"
    run = lambda rows: whiten(spark.createDataFrame(rows, schema)).collect()
    assert run([]) == [] and run([(1, None), (2, [])]) == []
    assert run([(1, [0.5, 0.25]), (2, [0.5, 0.25])]) == []  # no variance, no component
    line = run([(i, [i / 8, i / 4, 0.0]) for i in range(9)])
    assert {r.component for r in line} == {1} and np.isclose(line[0].explained, 1)
    two = run([(i, [float(i)]) for i in range(5)] + [(9, [1.0, 2.0]), (10, [3.0, 2.0])])  # lengths apart
    assert {(r.n, r.component) for r in two} == {(5, 1), (2, 1)}
    signed = run([(1, [-0.001]), (2, [0.0])])
    assert sorted(r.deviation for r in signed) == [1, 1]


def test_deviation_beyond_doubles_is_exact(spark):
    rows = [(i, [float(2**20 + i), float(-i)]) for i in range(900)]
    got = {r.vec_id: r.deviation for r in whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=1).collect()}
    assert got == dict(zip([r[0] for r in rows], by_numpy([r[1] for r in rows], 1)[1]))


def test_whitening_refuses_numbers_it_cannot_hold(spark):
    with pytest.raises(Exception, match="2\\^40"):
        whiten(spark.createDataFrame([(1, [1e30]), (2, [0.0])], "vec_id long, embedding array<double>")).collect()


def rotated(values, seed=5):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values),) * 2))[0]
    a = q @ np.diag(values) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize(
    "values",
    [[9.0, 3, 2, 1] + [0.5] * 20, [1.0] * 10, [5.0] * 6 + [1.0] * 6, [9.0, 3, 0, 0, 0], [3.0, 3 - 1e-6, 3 - 2e-6, 2, 1, 1], [2.0], [2.0, 1.0], list(np.linspace(1, 1.2, 90))],
)
def test_contour_integration_finds_every_eigenvalue_of_its_intervals(values):
    a = rotated(values)
    want = np.sort(values)[::-1]
    found = intervals(a, 4)
    pairs = [feast(a, *i) for i in found]
    got = np.concatenate([p[0] for p in pairs])
    assert len(got) == sum(c for *_, c in found) >= min(4, int((want > 0).sum()))
    assert np.allclose(got, want[: len(got)], atol=1e-12 * want[0])
    basis = np.hstack([p[1] for p in pairs])
    assert np.allclose(a @ basis, basis * got, atol=1e-10 * want[0])
    lows = [low for low, *_ in found]
    assert lows == sorted(lows, reverse=True) and all(h <= low + 1e-9 for (_, h, _), low in zip(found[1:], lows))


def test_inertia_counts_eigenvalues_below_a_shift():
    a = rotated(list(range(1, 21)))
    assert inertia(*tridiagonal(a), np.arange(0.5, 21)).tolist() == list(range(21))
