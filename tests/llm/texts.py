import random

WORDS = "the of and ering thion haor ston blean reth ondat inger eash".split()
GERMAN = "der und ung heit ichen schal ber zwei keiten lich strasse".split()


def prose(seed, words=60, vocabulary=WORDS):
    draw = random.Random(seed)
    return " ".join(draw.choice(vocabulary) + draw.choice(("", "", "a", "en", "is")) for _ in range(words))
