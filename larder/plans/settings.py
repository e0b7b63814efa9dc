"""Parameters of the registered queries: small configuration, the same for both engines."""

from larder.operators.sentiment import SentimentRules

COUNTRY = "nation_15"
MONTH = 6
BASKET = "ring, blue"
MISSING_BASKET = "saffron"
FALLBACK_BASKET = ["gear", "gizmo"]
SEGMENTS = ["🏆 Top Rated", "⚡ Quick & Easy"]

TAXONOMY = [
    ("ring", "fruit"), ("widget", "vegetable"), ("bolt", "vegetable"), ("gear", "meat"),
    ("rod", "fish"), ("old", "dairy"), ("cold", "egg"), ("hot plate", "grain"),
    ("red", "spice"), ("giz", "oil"),
]

LEXICON = [
    ("die", -2.9), ("no", -1.2), ("scum", -2.3), ("idiot", -2.3), ("trash", -1.5),
    ("worthless", -1.9), ("moron", -2.2), ("pathetic", -2.7), ("stupid", -2.4),
    ("loser", -2.4), ("disgusting", -2.4), ("best", 3.2), ("thing", 1.1), ("tion", 1.7),
    ("than", 2.3), ("erin", -1.4), ("thea", 0.9), ("erth", 1.3),
]

RULES = SentimentRules(
    boosters_up=("that", "more", "really"),
    boosters_down=("this", "hardly"),
    negations=("with", "from", "not", "never"),
    contrast="then",
    idioms=(("than the", 2.1), ("the than", -1.7), ("of the thea", 2.6), ("the and", 0.4), ("in the of", -0.8)),
    phrase_boosters=(("of the", 0.293), ("the in", -0.293), ("and the of", 0.293)),
)

PHRASES = [("mix until smooth", "melanger"), ("take the", "prendre le")]
TERMS = [("serve", "servir"), ("garnish", "decor"), ("ring", "anneau"), ("blue", "bleu")]
LABELS = [
    ("ring", "anneau"), ("rings", "anneaux"), ("bolt", "boulon"), ("gear", "boulon"),
    ("plate", "plat"), ("old", "vieux"),
]
