"""Fixed values the results depend on.

Everything in this module is a fixed value that must stay equal to the
behaviour being reproduced (label order, relationship matrix, slang list,
thresholds, tuning constants). Nothing here is derived; edit only to fix a
transcription error.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES: emotion label domain, index order 0..5.
# ---------------------------------------------------------------------------
EMOTIONS = ["Sadness", "Joy", "Love", "Anger", "Fear", "Surprise"]

# ---------------------------------------------------------------------------
# FIXED VALUES: emotion relationship matrix, rows = transcript emotion,
# columns = comment emotion, both in EMOTIONS order. Symmetric.
# ---------------------------------------------------------------------------
RELATIONSHIP_MATRIX = [
    [1.0, -1.0, -0.5, 0.5, 0.5, 0.2],   # Sadness
    [-1.0, 1.0, 0.5, -0.5, -0.5, 0.7],  # Joy
    [-0.5, 0.5, 1.0, -0.5, -0.2, 0.3],  # Love
    [0.5, -0.5, -0.5, 1.0, 0.3, 0.2],   # Anger
    [0.5, -0.5, -0.2, 0.3, 1.0, 0.1],   # Fear
    [0.2, 0.7, 0.3, 0.2, 0.1, 1.0],     # Surprise
]

# ---------------------------------------------------------------------------
# FIXED VALUES: relation scoring parameters and mismatch thresholds.
# ---------------------------------------------------------------------------
CES_LAMBDA = 0.5
WRS_BETA = 0.3
ECF_NONE_ABOVE = -0.2          # wrs > -0.2 -> no flag
ECF_HIGH_AT_OR_BELOW = -0.5    # wrs <= -0.5 -> high mismatch candidates
ECF_HIGH_MIN_CONF = 0.7        # both top confidences must exceed this
SARCASM_TRANSCRIPT = ["Joy", "Love"]
SARCASM_COMMENT = ["Anger", "Sadness"]
IRONY_TRANSCRIPT = ["Sadness", "Anger"]
IRONY_COMMENT = ["Joy", "Love"]

# ---------------------------------------------------------------------------
# FIXED VALUES: sentiment rule.
# ---------------------------------------------------------------------------
SENTIMENT_MIN_CONF = 0.5
NEGATIVE_EMOTIONS = ["Anger", "Sadness", "Fear"]

# ---------------------------------------------------------------------------
# FIXED VALUES: engagement benchmarks and performance bands
# (metric, benchmark, good_min, good_max).
# ---------------------------------------------------------------------------
ENGAGEMENT_BANDS = [
    ("likes_to_views_perc", 1.0, 1.0, 5.0),
    ("comments_to_views_perc", 0.5, 0.5, 0.5),
    ("views_to_subs_perc", 10.0, 10.0, 20.0),
]

# ---------------------------------------------------------------------------
# FIXED VALUES: pipeline defaults.
# ---------------------------------------------------------------------------
CHUNK_WORDS = 64
CHUNK_OVERLAP = 16
TOP_COMMENTS = 20
SEED = 42
SPLIT_TRAIN = 0.70
SPLIT_VAL = 0.15
SPLIT_TEST = 0.15
CENTROID_LOGIT_SCALE = 10.0

# ---------------------------------------------------------------------------
# FIXED VALUES: slang dictionary, in its original order. Later duplicate
# keys carry the same expansion as the first one.
# ---------------------------------------------------------------------------
SLANG = {
    "lol": "laugh out loud",
    "omg": "oh my god",
    "btw": "by the way",
    "idk": "i don't know",
    "lmao": "laughing my ass off",
    "smh": "shaking my head",
    "brb": "be right back",
    "gtg": "got to go",
    "tbh": "to be honest",
    "rofl": "rolling on the floor laughing",
    "thx": "thanks",
    "u": "you",
    "w": "with",
    "ur": "your",
    "r": "are",
    "k": "okay",
    "ikr": "i know right",
    "afk": "away from keyboard",
    "bff": "best friends forever",
    "gr8": "great",
    "imo": "in my opinion",
    "imho": "in my humble opinion",
    "fyi": "for your information",
    "ttyl": "talk to you later",
    "np": "no problem",
    "wtf": "what the heck",
    "wth": "what the heck",
    "tmi": "too much information",
    "gg": "good game",
    "hmu": "hit me up",
    "wyd": "what are you doing",
    "wya": "where are you",
    "ily": "i love you",
    "ily2": "i love you too",
    "idc": "i don't care",
    "omw": "on my way",
    "irl": "in real life",
    "bday": "birthday",
    "bae": "baby",
    "bro": "brother",
    "sis": "sister",
    "yolo": "you only live once",
    "fomo": "fear of missing out",
    "sus": "suspicious",
    "lit": "amazing",
    "dope": "cool",
    "srsly": "seriously",
    "nah": "no",
    "yea": "yes",
    "tho": "though",
    "gonna": "going to",
    "wanna": "want to",
    "gotta": "got to",
    "lemme": "let me",
    "gimme": "give me",
    "ain't": "is not",
    "cuz": "because",
    "coz": "because",
    "ya": "you",
    "nvm": "never mind",
    "omfg": "oh my god",
    "ffs": "for goodness sake",
    "pls": "please",
    "ppl": "people",
    "rn": "right now",
    "tldr": "too long didn't read",
    "xoxo": "hugs and kisses",
    "asap": "as soon as possible",
    "jk": "just kidding",
    "b4": "before",
    "bc": "because",
    "roflmao": "rolling on the floor laughing my ass off",
    "thot": "that hoe over there",
    "clout": "influence or popularity",
    "cap": "lie",
    "no cap": "no lie",
    "bet": "okay",
    "fam": "family",
    "savage": "fierce",
    "lowkey": "a little",
    "highkey": "a lot",
    "dm": "direct message",
    "stan": "superfan",
    "salty": "bitter or upset",
    "snatched": "looking good",
    "fire": "amazing",
    "tea": "gossip",
    "slay": "do something amazingly well",
    "flex": "show off",
    "ghosted": "ignored",
    "shipping": "want two people to be in a relationship",
    "vibe": "atmosphere or mood",
}
