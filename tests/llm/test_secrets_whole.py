"""Secrets beside pattern spans and allow-listed strings, and tokens of one letter case."""

import random
import string

import pytest

from reelhouse.llm import secrets

LOWER, UPPER, BASE32 = string.ascii_lowercase + string.digits, string.ascii_uppercase + string.digits, string.ascii_uppercase + "234567"
MIXED = string.ascii_letters + string.digits


def token(r, chars, n):
    return "".join(r.choice(chars) for _ in range(n))


def covered(text):
    return {i for s, _, e in secrets.scan_text(text)[1] for i in range(s, e)}


def test_a_secret_that_touches_a_pattern_is_kept():
    r = random.Random(1)
    whole = 0
    for _ in range(200):
        access, secret = "AKIA" + token(r, UPPER, 16), token(r, MIXED, 40)
        text = f"key {access}/{secret} end"
        base, every = secrets.scan_text(text)
        at = text.index("/")
        assert [(s, k, e) for s, k, e in every if k != 3] == base == [(4, 1, at)]
        assert all(e <= a or z <= s for s, _, e in base for a, k, z in every if k == 3)  # nothing is reported twice
        inside = covered(text) & set(range(at + 1, at + 41))
        assert len(inside) >= 24 and secret not in secrets.redact_text(text)
        whole += len(inside) == 40
    assert whole >= 180


def test_the_allow_list_names_tokens_only():
    r = random.Random(2)
    for name in ("EXAMPLE", "0123456789", "abcdefghij"):
        for _ in range(50):
            secret = token(r, MIXED, 40)
            for text in (f"{name}={secret}", f"{secret}={name}", f"{name}/path/that/goes/on/{secret}", f"{secret}/{name}"):
                assert len(covered(text) & set(range(text.index(secret), text.index(secret) + 40))) >= 24, text
    digest = "sha256-47DEQpj8HBSa+/TImW+5JCeuQeRkm5NMpJWZG3hSuFU="
    sample = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"
    for text in (digest, sample, f"KEY={sample}", "123e4567-e89b-12d3-a456-426614174000", "2024-01-02-03-04-05-06-07-08"):
        assert secrets.scan_text(text)[1] == []
    assert covered(f"{digest}/{secret}")


@pytest.mark.parametrize("chars,n,lost", [(LOWER, 20, 10), (LOWER, 40, 0), (UPPER, 20, 5), (BASE32, 16, 20), (BASE32, 32, 1)])
def test_tokens_of_one_letter_case(chars, n, lost):
    r = random.Random(3)  # a short token may hold no digit or repeat itself
    assert sum(not covered(f"a {token(r, chars, n)} b") for _ in range(300)) <= lost
    assert secrets.scan_text("ordinarylowercasewordsonly ORDINARYUPPERCASEWORDS some-longer-slug-of-words-2024")[1] == []


def test_one_character_repeated():
    assert secrets.scan_text("a1" + "=" * 60 + " " + "-" * 30)[1] == []
