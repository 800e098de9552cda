"""A small word list for use without list files. Longer lists come from ``read_lexicon``."""

POSITIVE_WORDS = """
    amazing authorized available beautiful benefit best better clear easy effective enjoy
    excellent fair fine free friendly glad good great happy helpful hope improve kind like
    love nice perfect pleased right safe strong success thank thanks useful valuable warm
    welcome well win winner wonderful work worth
""".split()

NEGATIVE_WORDS = """
    abuse angry awful bad breach broken claim crap cruel damage damages defect dirty error
    evil fail failure fault fool fraud garbage hate horrible hurt idiot idiots infringement
    junk kill liable liability lie limitation loser loss mistake moron pathetic poor problem
    sad scum sick stupid terrible trash ugly unable void vile weak worse worst worthless wrong
""".split()

DEFAULT_LEXICON = {word: -1 for word in NEGATIVE_WORDS} | {word: 1 for word in POSITIVE_WORDS}
