"""Cases that the tests share."""

#: NULL, empty, blank, one word, repeats, a very long text, marks only, other scripts
ODD = [None, "", " \n\t ", "word", "same same same same", "x " * 60_000, "a" * 50_000, "%%% $$$ ***", "日本語 テキスト", "é\u0000b\r\n", "word"]


def sentence(rng, n, words=400):
    return [f"w{rng.randrange(words)}" for _ in range(n)]
