import random
import re
import string

from kiln.llm import secrets as S


def brute(text):
    """The patterns as stated, matched leftmost without overlap, then dropped."""
    out = []
    assign = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for kind, pattern, ok in (("assign", assign, lambda m: len(m[2]) >= 8), ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
                              ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 32)):
        out += [(kind, m.start(), m.end()) for m in re.finditer(pattern, text) if ok(m)]
    return out


def test_base_spans_equal_the_stated_patterns():
    rnd = random.Random(1)
    bits = ["password", "PassWord", "passwd", "secret", "toKen", "tokEN", "api_key", "apikey", "ſecret", "=", ":", " ", "  ", '"', "'", "\n", "AKIA", "AKIAABCDEFGHIJKL",
            "0123456789abcdef", "abcdef", "XYZ", "é", "x", "-_.", "12345678", "🙂"]
    for _ in range(4000):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 25)))
        assert sorted(S.base_spans(text)) == sorted(brute(text)), repr(text)


def test_listing_order():
    assert S.listed([("hex", 5, 9), ("assign", 5, 20), ("novel", 1, 3)]) == "novel:1:3,assign:5:20,hex:5:9"
    assert S.listed([]) == ""


def random_string(rnd, n):
    return "".join(rnd.choice(string.ascii_letters + string.digits) for _ in range(n))


def test_random_strings_are_novel_and_words_are_not():
    rnd = random.Random(2)
    pack = S.packer(["connection_settings", "configuration", "token", "password"])
    for _ in range(30):
        key = random_string(rnd, 32)
        text = f"the credential is {key} for the service"
        assert S.novel_spans(pack, text, S.base_spans(text)) == [("novel", 18, 50)]
        plain = "the credential is connection_settings_configuration for the service"
        assert S.novel_spans(pack, plain, []) == []
        seen = f"{key} was shown, the credential is {key} again"
        assert S.novel_spans(pack, seen, S.base_spans(seen)) == []


def test_frame(docs_of):
    rnd = random.Random(3)
    key = random_string(rnd, 40)
    rows = [(1, f"password={key}"), (2, None), (3, ""), (None, "AKIA" + "A" * 12), (4, "f" * 50_000), (5, f"bearer {key}!"), (5, f"bearer {key}!"), (6, "no such thing")]
    got = S.scan(docs_of(rows, extra=True)).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["base"] == by[1]["spans"] == "assign:0:49"
    assert (by[2]["base"], by[3]["spans"], by[6]["spans"]) == ("", "", "")
    assert by[4]["base"] == "hex:0:50000" and by[None]["n_access"] == 1
    assert by[5]["base"] == "" and by[5]["spans"] == "novel:7:47"
    assert S.scan(docs_of([])).count() == 0


def test_identifiers_are_counted_over_all_rows(docs_of):
    rows = [(i, "my_config token other_name") for i in range(30)] + [(99, "token rare_name"), (100, "far_away words only")]
    words = S.identifiers(docs_of(rows))
    assert words[:3] == ["token", "my_config", "other_name"] and "rare_name" in words and "far_away" not in words


def test_copies_do_not_hide_a_secret():
    rnd = random.Random(6)
    pack = S.packer(["configuration", "token", "password"])
    for _ in range(30):
        key = random_string(rnd, 40)
        twice = f"the credential is {key} as in bearer {key}. And so on"
        assert [t[0] for t in S.novel_spans(pack, twice, S.base_spans(twice))] == ["novel"] * 2
        echo = f"the credential is {key} and, a good many words further on in the very same line, {key}."
        assert S.novel_spans(pack, echo, S.base_spans(echo)) == [("novel", 18, 58)]
        config = f"password={key} then bearer {key}"
        assert [config[a:b] for _, a, b in S.novel_spans(pack, config, S.base_spans(config))] == [key]


def test_length_does_not_hide_a_secret():
    rnd = random.Random(7)
    pack = S.packer(["configuration", "token", "password"])
    for n in (64, 128, 400, 800, 1500, 3000):
        for letters in (string.ascii_letters + string.digits + "+/", "0123456789ABCDEF"):
            for _ in range(20):
                text = "some words around it, bearer " + "".join(rnd.choice(letters) for _ in range(n)) + " and some after"
                assert S.novel_spans(pack, text, S.base_spans(text)) == [("novel", 29, 29 + n)], (n, letters)
    assert S.novel_spans(pack, "bearer " + random_string(rnd, 40) * 30, []) == [("novel", 7, 1207)]
    assert S.novel_spans(pack, "bearer " + "configuration" * 40, []) == S.novel_spans(pack, "bearer " + "=-" * 300, []) == []


def test_neighbours_do_not_hide_a_secret():
    rnd = random.Random(8)
    pack = S.packer(["configuration", "token", "password"])
    keys = "\n".join(f"bearer {random_string(rnd, 44)}" for _ in range(50))
    assert len(S.novel_spans(pack, keys, S.base_spans(keys))) == 50
    for _ in range(50):
        text = f"{random_string(rnd, 400)} then bearer {random_string(rnd, 44)} end {random_string(rnd, 400)}"
        assert ("novel", 413, 457) in S.novel_spans(pack, text, S.base_spans(text))
