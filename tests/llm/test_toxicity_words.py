from assay.llm.toxicity import word_features


def words(text):
    return [f for f in word_features(text) if not f.endswith("~")]


def test_joined_words_give_features():
    assert words("you,idiot/fool-clown\u2019s") == ["you", "idiot", "fool", "clown", "s"]
    assert words("idiot1") == words("idiot,idiot") == words("«idiot»") == ["idiot"]
    assert words("de\u0301bile") == words("d\u00e9bile") == ["d\u00e9bile"]  # decomposed and composed accents
    assert words("\u0939\u093f\u0928\u094d\u0926\u0940") == ["\u0939\u093f\u0928\u094d\u0926\u0940"]  # vowel signs
    assert words("\u2764\ufe0f") == words("4.0") == words("...") == []
