"""Small texts for the tests."""

import os
import random

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


def repeated_texts(seed: int) -> list[tuple[int | None, str | None]]:
    """Texts with copies, near copies, shared passages, periodic stretches, nulls, ties and one long text."""
    rng = random.Random(seed)
    words = ["ab", "ä", "cd e", "öß", "x", "yz", "日本", "q"]
    make = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = make(30)
    rows: list[tuple[int | None, str | None]] = [(-3, shared), (0, None), (1, ""), (2, "   "), (3, "a " * 60), (4, "a " * 25 + "b"), (5, make(3)), (None, shared), (None, None)]
    for i in range(6, 60):
        kind = rng.random()
        if kind < 0.3:
            rows.append((i, make(rng.randint(1, 40))))
        elif kind < 0.5:
            rows.append((i, make(5) + "\n" + shared[:rng.randint(10, len(shared))] + "\t" + make(5)))
        elif kind < 0.7:
            old = rng.choice([t for _, t in rows if t and t.strip()])
            at = rng.randrange(len(old))
            rows.append((i, old[:at] + rng.choice(["", "zz", " "]) + old[at:]))
        else:
            rows.append((i, rng.choice([t for _, t in rows])))
    rows += [rows[20], rows[20], (7, make(40)), (60, make(3000) + shared)]
    return rows
