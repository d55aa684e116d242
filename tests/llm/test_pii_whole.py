"""Values behind other groups of digits, and texts with very many values."""

import random
import time

from specfold.llm import feistel


def test_values_behind_other_groups():
    key = b"k"
    for text, want in (
        ("order 1 4111 1111 1111 1111 shipped", "4111 1111 1111 1111"),
        ("no. 12 4111-1111-1111-1111", "4111-1111-1111-1111"),
        ("qty 3 378282246310005 x", "378282246310005"),
        ("AB12 3456 DE89370400440532013000", "DE89370400440532013000"),
        ("7 7 7 4111 1111 1111 1111 7 7", "4111 1111 1111 1111"),
        ("12 12 DE89 3704 0044 0532 0130 00 12", "DE89 3704 0044 0532 0130 00"),
        ("1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8 9 4111111111111111", "4111111111111111"),
    ):
        spans = feistel.found(text, key)
        assert want in [text[a:b] for a, b, *_ in spans], text
        new = feistel.replaced(text, spans)
        assert want not in new and len(new) == len(text)
        assert spans == sorted(spans) and all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_a_card_behind_any_group():
    """However many digits stand before a card, it is never left in clear."""
    rng = random.Random(3)
    for _ in range(300):
        body = str(rng.randint(10**14, 10**15 - 1))
        card = body + next(c for c in "0123456789" if feistel.luhn(body + c))
        shown = " ".join(card[i : i + 4] for i in range(0, 16, 4)) if rng.random() < 0.5 else card
        text = f"item {rng.randint(0, 10 ** rng.randint(1, 6))} {shown} ok"
        assert shown not in feistel.replaced(text, feistel.found(text, b"k")), text


def test_many_values_in_one_text():
    text = "\n".join(f"user{i}@example.com logged in from 10.{i % 250}.{i // 250 % 250}.7" for i in range(10_000))
    began = time.process_time()
    spans = feistel.found(text, b"k")
    assert len(spans) == 20_000 and time.process_time() - began < 20
    few = feistel.found(text[: len(text) // 10], b"k")
    assert spans[: len(few) - 2] == few[:-2]
    assert feistel.replaced(feistel.replaced(text, spans), feistel.found(feistel.replaced(text, spans), b"k", back=True)) == text


def test_digits_in_single_groups_take_little_time():
    text = " ".join(str(i % 10) for i in range(60_000))
    began = time.process_time()
    feistel.found(text, b"k")
    assert time.process_time() - began < 30
