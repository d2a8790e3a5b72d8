"""Word lists and weights.

These must equal the published lists for results to agree (NLTK's English stop words;
Hutto & Gilbert 2014 for the sentiment rules), so they are stated plainly here.
"""

# English stop words.
STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself
yourselves he him his himself she she's her hers herself it it's its itself they them their
theirs themselves what which who whom this that that'll these those am is are was were be been
being have has had having do does did doing a an the and but if or because as until while of at
by for with about against between into through during before after above below to from up down
in out on off over under again further then once here there when where why how all any both each
few more most other some such no nor not only own same so than too very s t can will just don
don't should should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn
doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn
needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# ASCII punctuation marks.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Extra tokens dropped with the punctuation (left-overs of HTML line breaks).
MARKUP_TOKENS = ("<", ">", "br")

# Noun tags of the Penn Treebank tag set.
NOUN_TAGS = ("NN", "NNS", "NNP", "NNPS")

# Sentiment rule weights.
BOOST = 0.293
CAPS = 0.733
NEGATION = -0.74
DAMP = (1.0, 0.95, 0.9)
NORMALIZER = 15.0

# Negating words.
NEGATIONS = """
aint arent cannot cant couldnt darent didnt doesnt ain't aren't can't couldn't daren't didn't
doesn't dont hadnt hasnt havent isnt mightnt mustnt neither don't hadn't hasn't haven't isn't
mightn't mustn't neednt needn't never none nope nor not nothing nowhere oughtnt shant shouldnt
uhuh wasnt werent oughtn't shan't shouldn't uh-uh wasn't weren't without wont wouldnt won't
wouldn't rarely seldom despite
""".split()

# Words that raise the intensity of the next sentiment word.
BOOSTERS = """
absolutely amazingly awfully completely considerably decidedly deeply effing enormously entirely
especially exceptionally extremely fabulously flipping flippin fricking frickin frigging friggin
fully fucking greatly hella highly hugely incredibly intensely majorly more most particularly
purely quite really remarkably so substantially thoroughly totally tremendously uber unbelievably
unusually utterly very
""".split()

# Words that lower it.
DAMPENERS = """
almost barely hardly kinda kindof kind-of less little marginally occasionally partly scarcely
slightly somewhat sorta sortof sort-of
""".split()

# Two-word dampeners.
DAMPENER_PAIRS = ("just enough", "kind of", "sort of")

# Idioms with a valence of their own.
IDIOMS = {
    "the shit": 3.0,
    "the bomb": 3.0,
    "bad ass": 1.5,
    "yeah right": -2.0,
    "cut the mustard": 2.0,
    "kiss of death": -1.5,
    "hand to mouth": -2.0,
}

# Closed-class English words by Penn Treebank tag, for the tagger's back-off.
CLOSED_CLASS = {
    "DT": "the a an this that these those every each some any no all both".split(),
    "PRP": "i you he she it we they me him her us them myself himself itself".split(),
    "PRP$": "my your his its our their".split(),
    "IN": "of in on at by for with from into about over under after before because if "
    "while although though since until than as".split(),
    "CC": "and or but nor yet".split(),
    "MD": "can could may might must shall should will would".split(),
    "VB": "be do have get make go see".split(),
    "VBZ": "is has does".split(),
    "VBD": "was were had did got made went said".split(),
    "VBP": "am are".split(),
    "RB": "not never very too also just only even still here there now then again so".split(),
    "WDT": "which whatever".split(),
    "WP": "who whom what".split(),
    "WRB": "when where why how".split(),
    "TO": ["to"],
}
