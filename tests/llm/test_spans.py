from __future__ import annotations

import random
import re
import time

import numpy as np

from tabulary.llm import pii, secrets

from .fixtures import AWKWARD, documents

PII_PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
)


def brute_pii(text):
    found = []
    for kind, pattern in enumerate(PII_PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == 2 and not (13 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            found.append((kind, m.start(), m.end()))
    return found


def brute_secrets(text):
    names = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c + "?" for c in n) for n in ("password", "passwd", "secret", "token", "api_key"))
    found = [(0, m.start(), m.end()) for m in re.finditer(rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 12]
    found += [(1, m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(2, m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found, key=lambda s: (s[1], s[0]))


def test_base_personal_data_follows_the_patterns():
    draw = random.Random(1)
    for alphabet in ("0123456789.+- ()@ab", "012.", "a@.-", "4 -1"):
        for _ in range(1500):
            text = "".join(draw.choices(alphabet, k=60))
            assert pii.base_spans(text) == brute_pii(text), text


def test_base_secrets_follow_the_patterns():
    draw = random.Random(1)
    parts = ["password", "PassWd", "token", "api_key", "apiKEY", '"', "'", " ", "=", ":", "abcdef012345", "AKIA", "Z9Z9Z9Z9", "f", "x", "ſecret", "Kelvin"]
    for _ in range(3000):
        text = "".join(draw.choices(parts, k=20))
        assert secrets.base_spans(text) == brute_secrets(text), text


def test_boosted_trees_add_numbers_that_the_patterns_swallow(spark):
    draw = random.Random(2)

    def card():
        body = "4" + "".join(draw.choices("0123456789", k=14))
        return next(body + d for d in "0123456789" if pii.luhn(body + d))

    texts = [f"call +1 ({draw.randint(200, 999)}) 555-{draw.randint(1000, 9999)} or pay {card()} today" for _ in range(400)]
    texts += [f"order {draw.randint(10**15, 10**16)} of {draw.randint(1, 9)}.{draw.randint(0, 999)}.{draw.randint(256, 999)}.1 done" for _ in range(200)]
    joined = "write +1 (555) 555-1234 4111111111111111 soon"
    out = pii.find_pii(documents(spark, [*enumerate(texts), (9999, joined)])).where("doc_id = 9999").first()
    assert (out.n_card, out.n_phone) == (0, 0)
    assert out.spans == "card:24:40,phone:6:23"
    assert out.redacted == "write [PHONE] [CARD] soon"


def test_without_sure_cases_only_base_spans_are_found(spark):
    rows = {(r.doc_id, r.spans) for r in pii.find_pii(documents(spark, [*AWKWARD, (9, "a.b@c.de 10.0.0.1")])).collect()}
    assert (9, "email:0:8,ip:9:17") in rows and (1, "") in rows and (2, "") in rows and (None, "") in rows
    assert pii.find_pii(documents(spark, [])).count() == 0
    assert len(pii.find_pii(documents(spark, AWKWARD)).collect()) == len(AWKWARD)


def test_calibrated_threshold_needs_the_wanted_precision():
    draw = np.random.default_rng(0)
    x = np.zeros((3000, 4))
    x[:, 0] = 2
    x[:, 1] = draw.random(3000)
    y = (x[:, 1] > 0.5).astype(float)
    model = pii.fit(x, y)
    chosen = model.scores(x) >= model.least[2]
    assert y[chosen].mean() >= pii.PRECISION and model.least[0] == 2.0


def test_literals_reach_sensitive_names_through_constants():
    text = 'k1 = "Zx81qLm902Pw"\nservice_pwd = k1\ntitle = "Zx81qLm902Pw9"\n'
    spans = secrets.all_spans(text, secrets.base_spans(text))
    assert [text[s:e] for _, s, e in spans] == ["Zx81qLm902Pw"]
    cyclic = "a = b\nb = a\ndb_pass = a\nb = 'Zx81qLm902Pw'\n"
    assert [cyclic[s:e] for _, s, e in secrets.all_spans(cyclic, [])] == ["Zx81qLm902Pw"]
    assert secrets.all_spans("note: this is prose = fine", []) == []


def test_operands_may_stand_far_behind_their_sign():
    for blanks in (1, 8, 9, 40):
        (name, operands), *_ = secrets.assignments(f'signing ={" " * blanks}"x9Kq2LmZp7"')
        assert (name, [o[:2] for o in operands]) == ("signing", [("literal", "x9Kq2LmZp7")])


def test_secrets_of_awkward_rows(spark):
    docs = documents(spark, [*AWKWARD, (8, 'token = "abcdefabcdefabcd" and AKIAABCDEFGHIJKLMN')])
    rows = secrets.find_secrets(docs).collect()
    assert len(rows) == len(AWKWARD) + 1
    found = {r.doc_id: r for r in rows}
    assert (found[8].n_assign, found[8].n_hex, found[8].n_access) == (1, 1, 1)
    assert found[8].spans == "assign:0:25,hex:9:25,access:31:49" and found[8].masked == '[SECRET]" and [SECRET]'
    assert found[1].masked is None and found[2].masked == ""
    assert secrets.find_secrets(documents(spark, [])).count() == 0
    hidden = secrets.mask_secrets(docs)
    assert hidden.columns == docs.columns and {r.doc_id: r.text for r in hidden.collect()}[8] == found[8].masked


def test_long_texts_of_signs_and_numbers_take_seconds():
    begun = time.perf_counter()
    for text in ("a=b&" * 250_000, "a:b:" * 250_000, "k=1=" * 250_000, "password = x" + "=" * 500_000, "token: 'a " * 100_000):
        secrets.all_spans(text, secrets.base_spans(text))
    for text in ("1 " * 150_000, "+1 555 123 4567, " * 60_000, "1.2.3.4." * 120_000, "x" * 1_000_000 + " at y dot com", "a.b at c dot d " * 60_000):
        base = pii.base_spans(text)
        spans = pii.propose(text)
        sure = pii.Taken(base)
        for span in spans:
            pii.sure_label(text, span, sure)
        pii.select(spans, np.ones(len(spans)), base, [0.0] * len(pii.KINDS))
    assert time.perf_counter() - begun < 60


def test_operands_end_before_the_next_assignment():
    def spans(text):
        return [text[s:e] for _, s, e in secrets.all_spans(text, [])]

    assert spans("https://h/p?user=bob&token=Zx81kQ0pLm22&x=1") == ["Zx81kQ0pLm22"]
    assert spans("secret=QWxhZGRpbjpvcGVuIHNlc2FtZQ== next") == ["QWxhZGRpbjpvcGVuIHNlc2FtZQ=="]
    assert spans("note: password=hunter2XYZ99q") == ["hunter2XYZ99q"]
    assert spans("auth_token = aB3:xY9:kL0qWe77") == ["aB3:xY9:kL0qWe77"]


def test_chosen_spans_never_meet():
    draw = random.Random(4)
    for _ in range(50):
        spans = [(draw.randrange(2), s := draw.randrange(60), s + draw.randint(1, 9)) for _ in range(30)]
        chosen = pii.select(spans, np.array([draw.random() for _ in spans]), [], [0.3, 0.3])
        assert all(a[0] != b[0] or a[2] <= b[1] or b[2] <= a[1] for i, a in enumerate(chosen) for b in chosen[:i])
        assert len(chosen) == len(set(chosen))
