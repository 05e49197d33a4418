"""Names, weights, word lists and thresholds the results are defined by."""

# Event types.
WATCH = "WatchEvent"
PUSH = "PushEvent"
FORK = "ForkEvent"
PULL_REQUEST = "PullRequestEvent"
ISSUES = "IssuesEvent"
RELEASE = "ReleaseEvent"
CREATE = "CreateEvent"

# Weights of the daily activity score.
SCORE_WEIGHTS = {
    "stars": 1.0,
    "forks": 2.0,
    "pull_requests": 3.0,
    "unique_pushers": 2.5,
    "issues": 1.5,
}

# Owners and repository names kept out of the trending reports.
EXCLUDED_OWNERS = ["github", "dependabot"]
EXCLUDED_REPO_TEXT = "/.github"

# Marks of automated accounts in a login.
BOT_TEXT = "[bot]"
BOT_SUFFIX = "-bot"

# Topic fragments that make a repository part of the AI ecosystem.
AI_TOPICS = [
    "llm", "ai-agent", "mcp", "rag", "langchain", "ollama", "vector-database", "embedding",
    "openai", "anthropic", "machine-learning", "deep-learning", "transformer", "diffusion",
    "fine-tuning", "inference",
]

# Text fragments that do so for repositories in AI_TEXT_LANGUAGE.
AI_TEXT_LANGUAGE = "Python"
AI_TEXT = [
    "language model", "ai agent", "mcp server", "retrieval augmented", "vector store", "llm",
]

# Window lengths in days.
TRENDING_DAYS = 30
CONTRIBUTOR_DAYS = 90
ORG_DAYS = 30
HOURLY_DAYS = 7
COMMUNITY_DAYS = 90
NEW_REPO_DAYS = 30

# Labels with their lower bounds, highest first; the last entry is the label below them all.
ORG_TIERS = [("enterprise", 50), ("mid_size", 10), ("startup", 3), ("indie", None)]
VELOCITY_CLASSES = [("explosive", 10), ("viral", 5), ("accelerating", 3), ("steady", None)]
MOMENTUM = [("surging", 3), ("growing", 1.5)]
MOMENTUM_NO_LAST_WEEK = "new_to_radar"
MOMENTUM_OTHERWISE = "stable"

# Breakout tiers: label, least stars, greatest age in days.
BREAKOUT_TIERS = [("instant_hit", 500, 7), ("fast_mover", 200, 14), ("rising", 50, 30)]
BREAKOUT_OTHERWISE = "early_stage"

# Least repositories of a ranked organisation, forks of a measured repository,
# organisations of a migrating contributor and stars of a viral day.
MIN_ORG_REPOS = 2
MIN_FORKS = 2
MIN_ORGS = 2
MIN_RECENT_STARS = 5

# Enrichment: repositories per run; days of activity looked at; days a record stays fresh.
ENRICHMENT_BATCH = 500
ENRICHMENT_ACTIVE_DAYS = 7
ENRICHMENT_FRESH_DAYS = 7
