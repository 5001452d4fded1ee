"""Labels, patterns, markers and the stop-word list.

These decide the results and are therefore stated as they are. Flags of the
patterns (Java syntax): ``i`` ignores case, ``m`` lets ``$`` match at each line
end, ``d`` makes LF the only line end, ``U`` uses Unicode character classes.
``SPACE`` adds the four separators U+001C-U+001F that Java's Unicode ``\\s``
leaves out of its white space.
"""

SPACE = r"[\s\x1c-\x1f]"

# --- header fields (fixed values) -------------------------------------------
TITLE = rf"(?idU)Title:{SPACE}*(.+)"
LANGUAGE = rf"(?idU)Language:{SPACE}*(.+)"
ENCODING = rf"(?idU)Character set encoding:{SPACE}*(.+)"
RELEASE_DATE = rf"(?dmU)Release [Dd]ate:{SPACE}*(.+?)(?:{SPACE}*\[|$)"
POSTING_DATE = rf"(?dmU)Posting Date:{SPACE}*(.+?)(?:{SPACE}*\[|$)"
FOUR_DIGITS = r"([0-9]{4})"

# --- author and year of the influence network (fixed values) ----------------
AUTHOR = rf"(?idU)Author:{SPACE}*(.+)"
PARENTHESES = rf"(?dU){SPACE}*\(.*?\){SPACE}*"
NAMED_AUTHOR = r"(?is)\A(?!various\z)..+\z"  # two characters or more, not "various"
BYLINE = (
    r"(?dU)(?:Project Gutenberg[^\n]*\n.*?)?"
    r"by[\s\x1c-\x1f]+([A-Z][a-zA-Z\s\x1c-\x1f\.\,]+)"
)
BYLINE_CHARS = 2000  # the byline rule is defined on the first 2,000 characters
BYLINE_AUTHOR = r"(?s)\A.{4,99}\z"  # longer than 3, shorter than 100
RELEASE_YEAR = rf"(?dU)Release [Dd]ate:{SPACE}*.*?([0-9]{{4}})"
POSTING_YEAR = rf"(?dU)Posting Date:{SPACE}*.*?([0-9]{{4}})"

# --- boilerplate markers, tried in this order (fixed values) ----------------
START_MARKERS = (
    "*** START OF THIS PROJECT GUTENBERG",
    "*** START OF THE PROJECT GUTENBERG",
    "***START OF THIS PROJECT GUTENBERG",
    "***START OF THE PROJECT GUTENBERG",
)
END_MARKERS = (
    "*** END OF THIS PROJECT GUTENBERG",
    "*** END OF THE PROJECT GUTENBERG",
    "***END OF THIS PROJECT GUTENBERG",
    "***END OF THE PROJECT GUTENBERG",
    "End of the Project Gutenberg",
    "End of Project Gutenberg",
)
EVERY_MARKER_HOLDS = "Project Gutenberg"

# --- tokenisers (fixed values) ----------------------------------------------
CONTENT_WORD = "[a-z]{3,}"  # a run of letters longer than two
NOT_IN_WORDS = r"[^a-zA-Z' \t\n\x0B\f\r]+"  # deleted, so that "well-known" is one word
WORD_GAP = r"[ \t\n\r\f]+"

STOP_WORDS = tuple(
    """
    a an the and or but in on at to for of with by from as is was are were be
    been being have has had do does did will would could should may might shall
    can need dare ought used it its i me my myself we our ours ourselves you
    your yours yourself yourselves he him his himself she her hers herself
    itself they them their theirs themselves what which who whom this that these
    those am having doing if because until while about against between through
    during before after above below up down out off over under again further
    then once here there when where why how all both each few more most other
    some such no nor not only own same so than too very s t just don now
    """.split()
)
