"""The vocabularies by which sentences are read as claims (MIT licensed word lists), as regex text."""

CLAIM_VERBS = (
    "is|are|was|were|has|have|had|will|would|can|could|does|do|did|"
    "says?|said|states?|stated|reports?|reported|causes?|caused|fails?|failed|"
    "declines?|declined|fell|falls|rose|rises|raises?|raised|grew|grows|"
    "ends?|ended|retires?|retired|releases?|released|spends?|spent|refuses?|refused|"
    "plays?|played|stars?|starred|appears?|appeared|works?|worked|competes?|competed|"
    "participates?|participated|forces?|forced|makes?|made|drinks?|drank|"
    "worsens?|worsened|shortens?|shortened|cuts?|cut|passes?|passed|"
    "finishes?|finished|reduces?|reduced|increases?|increased|improves?|improved|"
    "shows?|showed|proves?|proved|suggests?|solves?|solved|"
    "contributes?|contributed|counteracts?|counteracted|occurs?|occurred|"
    "activates?|activated|links?|linked|alters?|altered|mediates?|mediated|"
    "diminishes?|diminished|prevents?|prevented|suppresses?|suppressed|"
    "took place|takes? place|put out"
)
AMOUNT = "\\d+(?:\\.\\d+)?\\s?(?:%|percent|million|billion|thousand)?"
NUMBER_WORDS = "one|two|three|four|five|ten|hundred"
QUANTITY_WORDS = "(?:one|two|three|four|five|ten)\\s+(?:hundred|thousand|million|billion|percent)"
CAUSAL = "because|therefore|as a result|causes?|caused|led to|due to|drives?|results? in"
HEDGE = "may|might|could|possibly|probably|likely|suggests?|appears|seems|roughly|approximately"
ABSOLUTE = "always|never|all|none|every|guarantees?|proves?|proved|certainly|impossible"
SOURCE = "according to|study|paper|report|dataset|survey|citation|source|evidence|table|figure"
NORMATIVE = "should|ought|must|need to|ethical|unfair|better|worse|good|bad"
DEFINITIONAL = "means|defined as|refers to"
PREDICTIVE = "will|is expected to|forecast|predict|by \\d{4}|next year|future"
HIGH_STAKES = (
    "illegal|legal|law|contract|lease|clause|court|statute|compliant|medical|treatment|diagnosis|drug|vaccine|patient|"
    "clinical|clinic|sterile|investment|stock|tax|financial"
)
MEDICAL = "medical|treatment|diagnosis|drug|vaccine|patient|clinical|clinic|sterile"
FINANCIAL = "investment|stock|tax|financial"
HISTORICAL = "in \\d{3,4}|during|historically|century|war|election"
WORLDLY = "real|world|people|system|policy|market|emissions|health|app|worker|workers|productivity|inspection|apartment|apartments|safe|safety"
CITATION = "\\[\\d+(?:\\s*,\\s*\\d+)*\\]"
URL = "https?://|www\\."
QUOTED = '["“][^"“”]+["”]'
ATTRIBUTION = (
    "said|says|argued|argues|claim(?:s|ed)?|wrote|writes|states?|stated|reports?|reported|told|asserts?|asserted|insists?|"
    "insisted|maintains?|maintained|contends?|contended|according to"
)
REFUTING = "wrongly|falsely|incorrectly|mistakenly|debunked|erroneously|disproven|disproved|refuted|untrue"
ANAPHORA = ("it", "this", "that", "these", "those", "which", "they")
IMPERATIVE = (
    "build", "make", "consider", "think", "do", "use", "start", "stop", "take", "let", "imagine", "remember", "note", "keep",
    "try", "ask", "avoid", "ensure", "create", "choose", "follow", "apply", "define", "describe", "explain", "suppose",
    "assume", "beware", "behold", "picture", "write",
)
CONJUNCT_HEADS = (
    "say", "says", "argue", "argues", "show", "shows", "note", "notes", "add", "adds", "explain", "explains", "suggest",
    "suggests", "claim", "claims", "push", "pushes", "lean", "leans", "rate", "rates", "see", "sees", "call", "calls",
)
ALARM_FLAGS = ("unsupported_major_claim", "overclaiming", "causal_inference_needs_evidence", "normative_warrant_needs_support")
VERIFIED_TYPES = ("empirical", "statistical", "causal", "predictive", "historical", "legal", "medical", "financial")
ABBREVIATIONS = (
    "Dr", "Mr", "Mrs", "Ms", "Prof", "St", "vs", "etc", "e.g", "i.e", "cf", "al", "Fig", "No", "Jr", "Sr", "Inc", "Ltd",
    "U.S", "U.K", "Ph.D", "z.B", "bzw", "ca", "Nr", "usw", "d.h", "u.a", "vgl", "Abs", "S", "Bd", "Hrsg", "Jh",
)
FICTION_CUES = (
    "he|she|they|her|him|his|said|asked|replied|whispered|thought|remembered|felt|knew|understood|doubted|suspected|looked|"
    "opened|closed|took|found|lit|slipped|tucked|checked|pressed|lifted|turned|paused|laughed|failed|raised|reflected|"
    "answered|smiled|door|room|coat|drawer|key|kitchen|lights|mirror|figure|window|latch|lantern|coin|signal|reflection|"
    "letter|envelope|skylight|cellar|hatch|chalk|mark|wall|radio|dial|static|voice|speaker|ink|message|rewrote|name|"
    "basement|freezer|drain|clock|elevator|hallway|bucket|rain|sky|water|orchard|trees|attic|map|paper|unfolded|behind|"
    "hand|mouth"
)
NONFICTION_CUES = (
    "policy|study|studies|evidence|data|therefore|thus|hence|because|however|moreover|furthermore|consequently|report|"
    "claim|claims|argument|premise|conclusion|research|analysis|percent|%"
)
SPEECH_VERBS = "said|asked|replied|whispered|muttered|shouted|exclaimed|answered"
STOP_WORDS = (
    "the", "a", "an", "and", "or", "but", "of", "to", "in", "on", "for", "with", "as", "at", "by", "is", "are", "was",
    "were", "be", "been", "being", "that", "this", "it", "its", "they", "their", "them", "we", "our", "you", "your", "he",
    "she", "his", "her", "i", "not", "no", "so", "if", "then", "than", "there", "here", "what", "which", "who", "how",
    "why", "when", "from", "into", "out", "up", "down", "over", "about", "would", "could", "will", "can", "may", "might",
    "do", "does", "did", "have", "has", "had", "more", "most", "some", "any", "all", "one", "also", "such", "these",
    "those", "very", "just", "like",
)
DANGLING_HEADS = ("it", "this", "that", "they", "these", "those")
