"""Small tables with every awkward case, and the same rows as plain Python values."""

import random

WORDS = "the of and stone river quiet walks under bright tower seven maps drift along copper".split()
GERMAN = "der die und straße größe nicht über wald haus fluss berg alt grün schön tür".split()


def prose(rnd, n, words=WORDS):
    return " ".join(rnd.choice(words) for _ in range(n))


def documents():
    """(doc_id, text, lang, source, n_chars)"""
    rnd = random.Random(11)
    texts = {}
    for i in range(60):
        texts[i] = (prose(rnd, rnd.randint(12, 90)), "en", f"s{i % 3}")
    for i in range(60, 90):
        texts[i] = (prose(rnd, rnd.randint(12, 90), GERMAN), "de", "s0")
    base = prose(rnd, 120, [f"w{k}" for k in range(400)])
    words = base.split()
    texts[90] = (base, "en", "s1")
    texts[91] = (base, "en", "s2")  # an exact copy
    for k in range(6):  # a chain of near copies, each a few words from the one before
        words = [*words[: 10 + 15 * k], f"new{k}", *words[11 + 15 * k :]]
        texts[92 + k] = (" ".join(words), "en", "s1")
    texts[98] = (" ".join(base.split()[:60]) + " " + prose(rnd, 60), "en", "s1")  # half of it
    texts[99] = ("", "en", "s1")
    texts[100] = (None, "en", "s1")
    texts[101] = ("!!! 123 ...", None, "s1")
    texts[102] = ("One two", "en", None)
    texts[103] = ("one TWO", "en", None)  # the same short sequence, in other case
    texts[104] = ("wort " * 30, None, None)
    texts[105] = (prose(rnd, 30) + " " + prose(rnd, 30, GERMAN), "en", "s0")
    texts[106] = (prose(rnd, 30_000, WORDS + GERMAN + ["\n", "漢字", "x#y", "\t"]), "en", "s2")
    texts[107] = ("emoji 😀 and \x1c odd   blanks  \r\n\x0b end ", "en", "s0")
    rows = [(i, t, lang, source, None if t is None else len(t)) for i, (t, lang, source) in texts.items()]
    rows.append(rows[5])  # a repeated row
    rows.append((None, texts[7][0], "en", "s1", 1))  # a row without id
    return rows


def benchmark():
    docs = {r[0]: r[1] for r in documents() if r[0] is not None}
    return [
        (1, " ".join(docs[90].split()[20:45])),
        (2, "Never Seen Words Stand Here And Make No Hit At All Today"),
        (3, "one, two"),  # shorter than a window
        (4, None),
        (5, " -- "),
        (1, " ".join(docs[90].split()[20:45])),
        (10, docs[3].upper()),
        (None, " ".join(docs[61].split()[:11])),
    ]


def conversations():
    return [
        (1, 0, "system", "be <|end|> kind"),
        (1, 1, "user", "a <\\|turn|> b"),
        (1, 2, "assistant", "one\ntwo <s> [INST] <<SYS>> \\"),
        (1, 3, "user", None),
        (1, 4, "assistant", ""),
        (1, 5, "user", "left over <"),
        (2, 0, "user", "no answer"),
        (3, 0, "assistant", "[\\\\/INST] </s>"),
        (4, 0, None, "x"),
        (4, 0, "assistant", "tie"),
        (4, 0, "assistant", "tie"),
        (None, 1, "user", "nobody"),
        *[(5, i, ("user", "assistant")[i % 2], f"turn {i}") for i in range(60)],
    ]


def labels():
    return [(i, i % 2, int(i % 4 == 0)) for i in range(60)] + [(3, None, None), (None, 1, 1), (4, 1, 0)]


TABLES = {
    "documents": (documents, "doc_id bigint, text string, lang string, source string, n_chars bigint"),
    "benchmark": (benchmark, "item_id bigint, text string"),
    "conversations": (conversations, "conv_id bigint, turn bigint, role string, text string"),
    "labels": (labels, "doc_id bigint, quality int, toxic int"),
}
