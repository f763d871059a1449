"""Tiny hand-sized inputs with golden results (see FIXTURES.md)."""

ARTICLE_LINES = [
    "1\tAlpha\t2010\t<p>The cloud, the <b>Cloud</b>s!</p>\\nRain&amp;sun",
    "2\tBeta, Inc\t2010\t<a>cloud</a>cloud computing",
    "3\tGamma\t2010\tno match 123 here",
    "4\tAlpha\t2011\tcloud again",
    "5\tEmpty\t2010\t<x/>",
    "6\tDelta\t2010\tCLOUD",
]

# (word, title, tf, df, w) for every word, N = 5.
TFIDF_ALL = [
    ("", "Empty", 1, 1, 0.698970004),
    ("again", "Alpha", 1, 1, 0.698970004),
    ("amp", "Alpha", 1, 1, 0.698970004),
    ("cloud", "Alpha", 3, 3, 0.665546249),
    ("cloud", "Beta, Inc", 2, 3, 0.443697499),
    ("cloud", "Delta", 1, 3, 0.221848750),
    ("computing", "Beta, Inc", 1, 1, 0.698970004),
    ("here", "Gamma", 1, 1, 0.698970004),
    ("match", "Gamma", 1, 1, 0.698970004),
    ("no", "Gamma", 1, 1, 0.698970004),
    ("rain", "Alpha", 1, 1, 0.698970004),
    ("s", "Alpha", 1, 1, 0.698970004),
    ("sun", "Alpha", 1, 1, 0.698970004),
    ("the", "Alpha", 2, 1, 1.397940009),
]

ARC_LINES = ["1\t2", "1\t3", "2\t3", "3\t1", "3\t4", "3\t6", "5\t1", "5\t1"]
LABEL_LINES = ["1\tAlpha", "2\tBeta Two", "3\tGamma", "4\tDelta", "5\tEps", "7\tIsolated"]

# name -> rank, rounded to 9 digits.
PAGERANK = {
    ("A", 1): {"Gamma": 1.486904762, "Alpha": 1.345238095, "Beta": 0.636904762, "Delta": 0.495238095},
    ("A", 2): {"Gamma": 1.358310185, "Beta": 0.816941138, "Delta": 0.66650463, "Alpha": 0.66650463},
    ("A", 10): {"Gamma": 0.724078197, "Delta": 0.41769085, "Alpha": 0.41769085, "Beta": 0.389651926},
    ("B", 1): {"Gamma": 1.497222222, "Alpha": 1.355555556, "Beta Two": 0.647222222, "Delta": 0.505555556},
    ("B", 2): {"Gamma": 1.37195216, "Beta Two": 0.821813272, "Delta": 0.669915123, "Alpha": 0.669915123},
    ("B", 10): {"Gamma": 0.724352556, "Delta": 0.417829708, "Alpha": 0.417829708, "Beta Two": 0.389769047},
    ("C", 1): {"Gamma": 1.425, "Alpha": 1.283333333, "Beta Two": 0.575, "Delta": 0.433333333},
    ("C", 2): {"Gamma": 1.184166667, "Beta Two": 0.695416667, "Delta": 0.55375, "Alpha": 0.55375},
    ("C", 10): {"Gamma": 0.514705073, "Delta": 0.297280462, "Alpha": 0.297280462, "Beta Two": 0.277561369},
}

GLUED_ARTICLE_1 = ["the", "cloud", "the", "clouds", "rain", "amp", "sun"]
TOKENS_ARTICLE_1 = ["the", "cloud", "the", "cloud", "s", "rain", "amp", "sun"]
