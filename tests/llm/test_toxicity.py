"""Features and decoding of toxicity scores."""

import numpy as np

from upcharts.llm import toxicity


def _bytes(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return data, np.array([0, len(data)])


def _features(text):
    return set(toxicity.word_features(*_bytes(text))[1].tolist())


def test_words_are_features_whole():
    assert _features("worthless") != _features("worthwhile")
    assert _features("worthless") - _features("worthwhile") and _features("worthwhile") - _features("worthless")
    # equal up to the last character, also in scripts of two and three bytes
    for a, b in (("abcdefghij", "abcdefghix"), ("недостойный", "недостойным"), ("東京特許許可局", "東京特許許可所")):
        assert _features(a) != _features(b)


def test_words_inside_other_words_are_met():
    for inner, outer in (("idiot", "superidiotisch"), ("馬鹿", "彼は馬鹿です"), ("дурак", "супердурак")):
        runs = {f for n in toxicity.GRAMS if len(inner) >= n for f in _runs(inner, n)}
        assert runs and runs <= _features(outer)


def _runs(word, n):
    before, toxicity.GRAMS = toxicity.GRAMS, (n,)
    try:
        both, toxicity.GRAMS = _features(word), ()
        return both - _features(word)
    finally:
        toxicity.GRAMS = before


def test_features_stay_in_their_text():
    texts = ["ab", "cd", "", "東京 x", "b"]
    raw = [t.encode() for t in texts]
    doc, feature = toxicity.word_features(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    for i, t in enumerate(texts):
        assert set(feature[doc == i].tolist()) == (_features(t) if t else set())


def _english():
    """A character model of a few words, as ``character_model`` counts it."""
    counts = np.full((toxicity.SYMBOLS,) * 3, 0.1)
    for word in ["idiot", "shit", "moron", "loser", "letter", "hello", "with", "this", "ass"] * 200:
        codes = [0, 0, *(ord(c) - 96 for c in word), 0]
        for x, y, z in zip(codes, codes[1:], codes[2:], strict=False):
            counts[x, y, z] += 1
    return np.log(counts / counts.sum(axis=2, keepdims=True))


def test_the_gate_passes_what_the_lattice_reads():
    restorer = toxicity.Restorer(_english())
    masked = {"a$$": "ass", "idio+": "idiot", "shi+": "shit", "iiddiioott": "idiot", "mmoron": "moron"}
    masked |= {sep.join("idiot"): "idiot" for sep in (" ", "  ", "/", ",", ", ", "\n", "|", " - ", ";;")}
    # what is clean stays
    masked |= {"hello": "hello", "letter": "letter", "hello!": "hello", "with this!": "with this", "a b": "a b"}
    for text, plain in masked.items():
        assert restorer.texts(*_bytes(text))[0].tobytes().decode().strip() == plain, text


def test_changed_words_stay_features_as_given():
    model = _english()
    model[1, 19, 19] = -30.0  # nothing but "as" is read where a second s follows
    restorer = toxicity.Restorer(model)
    assert restorer.texts(*_bytes("ass"))[0].tobytes() == b"as"
    found = set(toxicity.word_features(*restorer.texts(*_bytes("ass"), given=True))[1].tolist())
    assert _features("ass") <= found and _features("as") <= found


def test_very_long_stretches_take_time_in_proportion():
    import time

    random = np.random.default_rng(2)
    model = np.log(random.dirichlet(np.ones(28), (28, 28))).tolist()
    seconds = []
    for n in (50_000, 400_000):
        text = "".join(random.choice(list("abcd0123XYZ+/"), n))
        began = time.process_time()
        assert len(toxicity.decode(text, model)) > n // 2
        seconds.append(time.process_time() - began)
    assert seconds[1] < 16 * seconds[0] + 1
