"""Fixed values that results depend on."""

# English stop words.
STOPWORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers "
    "herself it its itself they them their theirs themselves what which who whom this that these those am is are "
    "was were be been being have has had having do does did doing a an the and but if or because as until while "
    "of at by for with about against between into through during before after above below to from up down in out "
    "on off over under again further then once here there when where why how all any both each few more most "
    "other some such no nor not only own same so than too very s t can will just don should now"
).split()

# ASCII punctuation.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# The labels a scorer may return.
SENTIMENTS = ("positive", "negative", "neutral")

# Fixed value: the prompt given to a generative scorer.
PROMPT_TEMPLATE = (
    "Instruction: Given the financial news, classify the sentiment of the news into one of the following "
    "categories: positive, negative, neutral.\nInput: {text}\nAnswer: "
)

# Fixed value: the prompt of the daily feature job.
FEATURE_PROMPT_TEMPLATE = (
    "Instruction: What is the sentiment of this news? Please choose an answer from {negative/neutral/positive}.\n"
    "Input: {input}\nAnswer: "
)

# Fixed value: the label that keeps a prompt token out of the loss.
IGNORE_LABEL = -100

# Characters a text is split at: Unicode white space and the four ASCII separators.
WHITESPACE = (
    r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

# The same characters one by one.
SPACES = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
