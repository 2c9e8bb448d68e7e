"""Fixed values.

Everything in this file is data, not logic: word lists, markers and formats that
have to be exactly these for results to come out right.  Each list is the default
of an option in :mod:`dialoom.config`; pass your own to replace it.
"""

from __future__ import annotations

# ---- fixed values: roles -------------------------------------------------------
SYSTEM = "system"
HUMAN = "human"
GPT = "gpt"
ROLE_NAMES = {"user": HUMAN, "assistant": GPT}

# ---- fixed values: text formats ------------------------------------------------
QA_PREFIX = "search_query: "
QA_SEPARATOR = " [SEP] "
DEFAULT_SYSTEM_PROMPT = (
    "Master input meaning and intent to synthesize clear, coherent, and relevant responses."
)
DEFAULT_CURRENT_PROMPT = "Provide a response to the instruction."
GENERATED_PROMPT_MARKER = "New System Prompt:"
MOJIBAKE_APOSTROPHE = "â€™"
ANSI_ESCAPE_PATTERN = r"\x1B(?:[@-Z\\-_]|\[[0-?]*[ -/]*[@-~])"

# Characters that Python's str.strip() and str.split() treat as white space.
PYTHON_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# ---- fixed values: an answer is cut at the first of these -----------------------
CUT_MARKERS = (
    "Remember, it's important",
    "Remember, it's always important",
    "Remember, it’s important",
    "Remember, it’s always important",
)

# ---- fixed values: lines that start a reference section -------------------------
SECTION_HEADERS = (
    "Notes and references",
    "Notes",
    "See Also",
    "References",
    "External links",
    "Further reading",
    "Bibliography",
    "Footnotes",
)
# The same list with the last two run together, so that neither works alone.
SECTION_HEADERS_STRICT = SECTION_HEADERS[:6] + ("BibliographyFootnotes",)

# ---- fixed values: text after any of these is not part of a generated prompt ----
GENERATION_STOP_MARKERS_STRICT = (
    "EXPLAINATIONS:",
    "CURRENT SYSTEM PROMPT:",
    "NEW SYSTEM PROMPT:",
    "USER PROMPT:",
    "MY RESPONSE:",
    "My Response:",
    "GENERAL",
    "Remember:",
    "User Prompt:",
    "My Response:",
    "GPT Response:",
    "Perspective:ASSISTANT:",
    "USER:",
    "User:",
    "Note:",
    "SYSTEM:",
    "Current System Prompt",
    "New System Prompt",
    "[end of text]",
    "<!",
    "```",
)
# The same list with the run-together pair taken apart.
GENERATION_STOP_MARKERS = (
    GENERATION_STOP_MARKERS_STRICT[:11]
    + ("Perspective:", "ASSISTANT:")
    + GENERATION_STOP_MARKERS_STRICT[12:]
)

# ---- fixed values: regular expressions that reject a message --------------------
REJECTION_PHRASES = (
    "AI",
    "language model",
    "openai",
    "I am sorry",
    "I'm sorry",
    "I apologize",
    "I cannot",
    "I can't",
    "I will not",
    "chinese",
)

# ---- fixed values: phrases removed from answers, in order of removal ------------
STRIP_PHRASES = (
    "Ah, ",
    "Sure.",
    "Sure!",
    "Great!",
    "Hello!",
    "Exactly!",
    "Of course!",
    "Certainly.",
    "Certainly!",
    "I hear you.",
    "Absolutely!",
    "Definitely!",
    "Happy coding!",
    "The answer is ",
    "You're welcome!",
    "The answer is: ",
    "You’re welcome!",
    "Great question!",
    "Hope this helps!",
    "Cognitive biases!",
    "I hope that helps",
    "I'm happy to help!",
    "I hope this helps!",
    "You're very welcome!",
    "You're very welcome.",
    "Sure, I can do that.",
    "Interesting question!",
    "The age-old question!",
    "That's great to hear!",
    "Interesting questions!",
    "What a great question!",
    "I'm glad to hear that!",
    "What a fascinating task!",
    "Great, I'm happy to help!",
    "Sure, I'd be happy to help!",
    "I hope these examples help!",
    "As an unbiased AI assistant,",
    "Here's a descriptive answer:",
    "Good luck, and happy coding!",
    "Let me know if you need that.",
    "Yes, I can help you with that.",
    "I apologize for the confusion.",
    "I hope this information helps!",
    "The answer to this equation is ",
    "Sure, I can help you with that.",
    "The answer to this expression is ",
    "I hope this helps clarify things!",
    "Really hope that will be helpful.",
    "I hope this answers your question.",
    "Please let me know your preference.",
    "I hope this information was helpful!",
    "Sure, I can help you with that task.",
    "Sure, I'd be happy to help with that!",
    "Sure, I'd be happy to help with that.",
    "Let me know if you have any questions.",
    "Let me know if you need any more help.",
    "Let me know if you have any questions!",
    "Let me know if you need any more help!",
    "Please let me know if that's the case.",
    "Let me know if you need further assistance!",
    "If you have any questions, feel free to ask!",
    "Let me know if you have any other questions.",
    "Please let me know if you need further help.",
    "Please let me know if you need anything else.",
    "Please let me know if you have any questions.",
    "Let me know if you have any further questions.",
    "I apologize if my previous response was unclear",
    "Absolutely, I'd be happy to help you with that.",
    "Let me know if you need help with anything else!",
    "Please let me know if you have any other queries.",
    "Please let me know if you have any other concerns.",
    "Do let me know if you need help with anything else.",
    "Please let me know if you have any other questions!",
    " and let me know if you need help with anything else",
    "Please let me know if you have any further questions.",
    "Please let me know if you have any further questions!",
    "Please let me know if there is anything else you need.",
    "Please, let me know if you need help with anything else.",
    "Let me know if you have any other questions about Python.",
    "Let me know if there's anything else I can assist you with.",
    "Please let me know if there's more assistance I can provide!",
    "Let me know if you have any questions or need further assistance.",
    "Let me know if you have any questions or need further clarification.",
    "Let me know if you have any questions, or if you need additional help.",
    "Please let me know if there's any part of it you want me to expand on.",
    "If you have any more questions, or need further assistance, don't hesitate to ask.",
    "Let me know if you have any questions or if you'd like to start working on this project.",
    "Let me know if you have any more questions or if you'd like to practice with more examples.",
    "Let me know if you have any other questions or if there's anything else I can assist you with.",
    "Let me know if you have any other questions or if you'd like me to assist you with anything else.",
    "Please let me know if this doesn't meet your requirements and I'll adjust the program accordingly.",
    "Please let me know if you have any further questions or if there's anything more I can help you with.",
)

# ---- fixed values: code points beyond ASCII that count as code ------------------
CODE_POINTS = (
    0x2190, 0x2191, 0x2192, 0x2193, 0x2194, 0x2195, 0x21D2, 0x21D4, 0x2200, 0x2203,
    0x2205, 0x2208, 0x2209, 0x220B, 0x220C, 0x220F, 0x2211, 0x2213, 0x2215, 0x221A,
    0x221D, 0x221E, 0x2220, 0x2227, 0x2228, 0x2229, 0x222A, 0x2234, 0x2235, 0x2237,
    0x223C, 0x2248, 0x2260, 0x2261, 0x2264, 0x2265, 0x226A, 0x226B, 0x2282, 0x2283,
    0x2284, 0x2285, 0x2286, 0x2287, 0x2295, 0x2296, 0x2297, 0x2298, 0x22A5, 0x22C5,
    0x2308, 0x2309, 0x230A, 0x230B, 0x2329, 0x232A, 0x25A0, 0x25A1, 0x25AA, 0x25AB,
    0x25B2, 0x25B3, 0x25BC, 0x25BD, 0x25C6, 0x25C7, 0x25CF, 0x25EF, 0x2605, 0x2606,
    0x03B1, 0x03B2, 0x03B3, 0x03B4, 0x03B5, 0x03BB, 0x03C0, 0x03C3, 0x03C9, 0x2070,
    0x00B9, 0x00B2, 0x00B3, 0x2074, 0x2075, 0x2076, 0x2077, 0x2078, 0x2079, 0x2080,
    0x2081, 0x2082, 0x2083, 0x2084, 0x2085, 0x2086, 0x2087, 0x2088, 0x2089, 0x2026,
    0x00A9, 0x00AE, 0x2122, 0x20AC, 0x00A3, 0x00A5, 0x2713, 0x2717, 0x21B5, 0x2262,
    0x2102, 0x210D, 0x2115, 0x2119, 0x211A, 0x211D, 0x2124, 0x2128, 0x2132, 0x213A,
    0x2135, 0x2136, 0x2137, 0x2138, 0x21D0, 0x21D1, 0x21D3,
)
