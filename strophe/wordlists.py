"""Section keywords, label names, word lists and characters.

Results only agree with the published pipeline when these agree, so they are
stated here as plain text and nowhere else.
"""

# Section keywords that may stay in square brackets (case-sensitive).
SECTION_KEYWORDS = (
    "Chorus Verse Bridge Intro Outro Hook Prehook Posthook Introduction Interlude Coda Conclusion Refrain"
).split()

# Keywords of a line that is only a header.
HEADER_ONLY_KEYWORDS = (
    "Hook Chorus Bridge Verse Outro Intro Refrain Prehook Posthook Coda Interlude Conclusion"
).split()

# Keywords that mark a repeated section.
CHORUS_KEYWORDS = "Hook Chorus Refrain Bridge".split()

# Keywords that may stand without brackets; "Verse" and "Chorus" carry an optional number.
BARE_KEYWORDS = [
    "Introduction", "Interlude", "Coda", "Hook", "Prehook", "Posthook", "Conclusion", "Refrain",
    r"Verse \p{Nd}*", "Intro", "Outro", r"Chorus \p{Nd}*", "Bridge",
]

# The eight emotions; the position is the class index, for training and for decoding alike.
EMOTIONS = ["anger", "anticipation", "disgust", "fear", "joy", "sadness", "surprise", "trust"]

GENRES = ["country", "pop", "rap", "rb", "rock"]

# What Python's str.strip() removes.
WHITESPACE = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
              *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)

# The English stop-word list of NLTK.
ENGLISH_STOPWORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves he him his
himself she she's her hers herself it it's its itself they them their theirs themselves what which who whom this
that that'll these those am is are was were be been being have has had having do does did doing a an the and but
if or because as until while of at by for with about against between into through during before after above below
to from up down in out on off over under again further then once here there when where why how all any both each
few more most other some such no nor not only own same so than too very s t can will just don don't should
should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't
haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't
weren weren't won won't wouldn wouldn't
""".split()

# Further words and marks dropped before key terms are computed ("'''s" is one entry on purpose).
EXTRA_STOPWORDS = """
? ( ) . [ ] ! ... ; \\` ' " `` "" '''s 'll ca n't 'm 're 've na wan one two three four five six seven eight nine
ten zero cos er mow go get oh love know like see make come let say take want would
""".split()

PUNCTUATION = list("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")

KEY_TERM_STOPWORDS = sorted({*ENGLISH_STOPWORDS, *EXTRA_STOPWORDS, *PUNCTUATION})

# Contractions a Treebank tokeniser splits in two.
CONTRACTIONS = {
    "cannot": ("can", "not"),
    "gimme": ("gim", "me"),
    "gonna": ("gon", "na"),
    "gotta": ("got", "ta"),
    "lemme": ("lem", "me"),
    "wanna": ("wan", "na"),
}
