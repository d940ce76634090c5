"""Closed vocabularies and patterns. All are fixed values: results depend on them literally."""

# Lesson voice jobs, and the ones meant for guest positions only.
DOMINANT_JOBS = ["show-how", "derive-why", "demystify", "economics", "frame", "sustain", "motivate"]
GUEST_ONLY_JOBS = ["frame", "demystify"]

# Required brief keys. A build lesson needs the second list too.
BRIEF_CORE_KEYS = [
    "id", "title", "objectives", "prerequisites", "hook", "concept_spec",
    "the_tradeoff", "just_in_time", "assessment", "difficulty", "dominant_job",
]
BRIEF_BUILD_KEYS = ["artifact_spec", "exercise_spec", "fading"]
LESSON_KINDS = ["build", "concept"]

# Verbs.
WEAK_VERBS = ["know", "understand", "learn", "be aware", "appreciate", "grasp"]
PASSIVE_GATE = r"(?i)\b(watch|read|review the video|listen|observe)\b"
DOING_GATE = r"(?i)\b(build|write|deploy|derive|implement|test|pass|ship|fix|run|submit|create)\b"

# Challenges.
CHALLENGE_LANGS = ["rust", "typescript"]
BUILD_TYPES = ["standard", "buildable"]
SOURCE_EXT = {"rust": ".rs", "typescript": ".ts"}

# Surfaces a verified claim may cite.
KIT_SURFACES = ["solana-dev", "context7", "helius", "surfpool", "deep-research",
                "solana-researcher", "solana-guide", "local-execution", "web", "websearch"]

# Visual specs.
VISUAL_TYPES = ["flowchart", "diagram", "chart", "table", "comparison", "annotated-code", "timeline"]
VISUAL_FIELDS = ["type", "title", "purpose", "data", "prompt", "alt"]
WEAK_ALT_PREFIXES = ["image of", "diagram of", "visual of", "illustration of"]

# Lesson life cycle.
LIFECYCLE = ["briefed", "researched", "drafted", "verified", "published"]

# Thresholds.
LESSON_TARGET_MIN = 3000
WALL_ADVISORY, WALL_HARD = 450, 700
FIRST_DO_WORDS, FIRST_DO_WORDS_OPENER = 300, 150
VISUAL_WORDS_PER, VISUAL_MIN = 600, 2
DEPTH_MIN, DEPTH_MAX = 2400, 5500
UNKNOWN_MODULE_POS, UNKNOWN_MODULE_STEM = 1_000_000, 99

# Phrases a brief or draft must not contain.
DEFAULT_BLOCKLIST = ["movie review", "student intro", "restaurant review", "completed the lab?", "60 days of solana"]

# Command -> the installer text a draft must mention, in reporting order.
TOOL_INSTALLERS = [
    ("anvil", "foundryup"), ("forge", "foundryup"), ("cast", "foundryup"),
    ("cargo build-sbf", "rustup"), ("cargo new", "rustup"), ("anchor", "avm"),
    ("solana", "release.anza.xyz"), ("solana-keygen", "release.anza.xyz"),
    ("bitcoind", "bitcoin"), ("npx tsx", "npm install"), ("ts-node", "npm install"),
]
SHELL_LABELS = ["bash", "sh", "shell", "console", "zsh"]

# Fence tag -> language.
FENCE_LANGS = {
    "py": "python", "python": "python", "sh": "bash", "bash": "bash", "shell": "bash", "console": "bash",
    "sol": "solidity", "solidity": "solidity", "rs": "rust", "rust": "rust", "ts": "typescript",
    "tsx": "typescript", "typescript": "typescript", "js": "javascript", "javascript": "javascript",
    "json": "json", "toml": "toml",
}

# The runner's sandbox.
SANDBOX_MODULE = "@solana/web3.js"
MISSING_GLOBALS = ["URLSearchParams", "URL", "fetch", "Buffer", "btoa", "atob", "XMLHttpRequest",
                   "Headers", "Request", "Response", "structuredClone", "crypto"]
KNOWN_ARGS = ["connection", "wallets", "data", "buffer", "expectedSeeds", "account", "position",
              "payer", "sender", "recipient", "owner", "authority", "mint", "senderKeypair",
              "recipientKeypair", "userKeypair", "programId", "userPubkey", "recipientPubkey",
              "senderPublicKey", "expectedOwner", "tokenProgramId", "systemProgramId", "dataAccount"]

# Rust path heads that are not crates.
RUST_NOT_CRATES = ["crate", "self", "super", "std", "core", "alloc"]

# Diagnostic classes.
TS_UNRESOLVED = r"error TS(2304|2307|2552|2503|2686|2580|2792|7016|18004)\b"
TS_ADVISORY = r"error TS(7005|7006|7008|7031|7034)\b"
SYNTAX_ERROR = (r"error TS1\d{3}\b|error: expected|error: unexpected|is not followed by an item"
                r"|error: mismatched closing|error\[E0584\]")
RUST_UNRESOLVED = (r"error\[E(0432|0433|0412|0425|0405|0422|0531|0603)\]"
                   r"|cannot find (\w+ )?(type|value|function|macro|struct|trait|attribute)"
                   r"|failed to resolve|use of undeclared|error\[E0583\]"
                   r"|error\[E0423\]: expected value, found macro")
WRAPPED_INFERENCE = r"error\[E028[23]\]|type annotations needed"
WRAPPER_NAME = "__Block"

# CSS the card renderer drops.
FORBIDDEN_CSS = ["box-shadow", "background-image:url(", "background-image: url(", "font-stretch",
                 "position:fixed", "position: fixed", "display:contents", "display: contents"]

# First words a smoke command may use.
SMOKE_ALLOWLIST = ["python3", "python", "shasum", "sha256sum", "printf", "echo", "openssl"]

# Length bands per form, in words.
LENGTH_BANDS = [("tutorial", 800, 2500), ("explainer", 1500, 4000), ("essay", 1000, 3500),
                ("litepaper", 1500, 5000), ("thread", 400, 1200)]

# Ask keyword -> form; the first match in this order wins.
FORM_KEYWORDS = [
    ("slides", r"\b(slides|deck|presentation|talk|workshop)\b"),
    ("post", r"\btweet\b"),
    ("post", r"\bthread\b|🧵"),
    ("post", r"\b(tl;dr|blurb|announcement note)\b"),
    ("tutorial", r"\btutorial\b|how do i build|step-by-step"),
    ("walkthrough", r"\bwalkthrough\b|code tour|explain this (repo|protocol|transaction)"),
    ("explainer", r"\b(explainer|primer|deep-dive)\b|\bhow .+ works\b|\bwhat is\b"),
    ("essay", r"\b(essay|opinion)\b|\bwhy .+ should\b"),
    ("explainer", r"\b(blog post|article about)\b"),
    ("tutorial", r"\b(cookbook|snippet)\b|how do i .+ in \d+ lines"),
    ("walkthrough", r"annotated readme|docs for this repo"),
    ("litepaper", r"\b(litepaper|whitepaper|tokenomics paper)\b"),
    ("course", r"\b(course|curriculum|syllabus|bootcamp)\b"),
]

# Publishing.
DEFAULT_CREATOR = "REPLACE_WITH_YOUR_SOLANA_WALLET"
ASSET_CAP_BYTES = 1 << 20
RASTER_EXT = ["png", "jpg", "jpeg", "webp", "gif"]
