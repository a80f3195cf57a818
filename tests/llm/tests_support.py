"""A small corpus with planted cases."""

WORDS = [a + b + c for a in ("ba", "re", "lo", "mi", "tu", "ka", "so", "ne") for b in ("ra", "ne", "to", "li", "mu") for c in ("k", "st", "de", "va", "n")]
BAD = ["vilewort", "grubface", "dungheap", "snotrag"]


def planted_documents(rng):
    """(documents, labels, doc_ids of clean and toxic documents and of groups of near copies)."""
    docs, labels, known = [], [], {"clean": [], "toxic": [], "near": []}

    def add(words, lines=True):
        i = len(docs)
        text = " ".join(words)
        if lines and rng.random() < 0.3:
            text += "\nSubscribe to our letter"
        docs.append((i, text, "en", f"src{rng.choice([0, 0, 0, 1, 2])}", len(text)))
        return i

    def prose(n):
        return [rng.choice(["the", "of", "and"]) if rng.random() < 0.3 else rng.choice(WORDS) for _ in range(n)]

    for k in range(700):
        words = prose(rng.randint(40, 160))
        if k % 8 == 0:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
            known["toxic"].append(add(words))
        else:
            known["clean"].append(add(words))
        labels.append((len(docs) - 1, 1, int(k % 8 == 0)))
    for _ in range(12):
        words = prose(200)
        group = [add(words, False)]
        for _ in range(rng.randint(1, 6)):
            x = list(words)
            x[rng.randrange(200)] = rng.choice(WORDS)
            group.append(add(x, False))
        known["near"].append(group)
    return docs, labels, known
