"""Fixed values that results depend on: limits, name sets, ranges, templates, word lists."""

# --- Fixed values: limits -------------------------------------------------------------
MAX_FILE_SIZE = 5 * 1024 * 1024
MAX_CONTENT_CHARS = 5_000_000
TXT_SIZE_CAP = 1 * 1024 * 1024
JSON_SIZE_CAP = 5 * 1024 * 1024
CHUNK_ROWS = 10_000
SHARD_TARGET = 10 * 1024**3
SHARD_MIN = 5 * 1024**3
SHARD_MAX = 20 * 1024**3
ZSTD_LEVEL = 3
PAGE_SIZE = 100
MAX_PAGES = 10
EMPTY_PAGE_RETRIES = 5
SCRAPE_PAGE_RECORDS = 10
CONTEXT_BEFORE = 200
CONTEXT_AFTER = 3000
RATE_WINDOW_SECONDS = 60

# --- Fixed values: file name sets -----------------------------------------------------
CODE_EXTENSIONS = [
    ".py", ".pyx", ".pyi", ".pyw", ".ipynb",
    ".js", ".ts", ".jsx", ".tsx", ".java", ".cpp", ".c", ".h", ".hpp", ".cs",
    ".go", ".rs", ".rb", ".php", ".swift", ".kt", ".scala", ".r", ".jl",
    ".sh", ".bash", ".zsh", ".fish",
]
TEXT_EXTENSIONS = [
    ".md", ".rst", ".txt",
    ".json", ".yaml", ".yml", ".toml", ".xml", ".cfg", ".ini", ".conf",
    ".csv", ".tsv",
    ".html", ".css", ".scss", ".sass", ".less",
    ".lock", ".requirements",
    ".gitignore", ".gitattributes", ".editorconfig", ".env",
]
ALWAYS_KEEP_NAMES = [".git", ".github", "LICENSE", "NOTICE", "COPYING", "AUTHORS"]
BLOCKED_NAME_PARTS = ["solutions", "resources", "topics", "sponsors"]

# --- Fixed values: search dimensions --------------------------------------------------
SORTS = ["stars", "updated", "forks"]
API_STAR_RANGES = [">=500", "200..499", "100..199", "50..99", "20..49", "10..19", "5..9"]
API_TEMPLATES = [
    "language:python topic:{topic} stars:{stars}",
    'language:python "{topic}" in:readme stars:{stars}',
]
WEB_STAR_RANGES = [
    ">=10000", "5000..9999", "2000..4999", "1000..1999", "500..999", "200..499",
    "100..199", "50..99", "20..49", "10..19", "5..9", "1..4",
]
WEB_TEMPLATES = [
    "language:python topic:{topic} stars:{stars}",
    'language:python "{topic}" in:readme stars:{stars}',
    'language:python "{topic}" in:description stars:{stars}',
]
STAR_LEVELS = [5000, 2000, 1000, 500, 200, 100, 50, 20, 10, 5, 1]

# --- Fixed values: dimensions of the nine crawl query families ------------------------
CRAWL_SORT_LABELS = [("stars", "most stars"), ("updated", "recently updated"), ("forks", "most forks")]
CRAWL_TOPICS = [
    "machine-learning", "deep-learning", "neural-network", "pytorch",
    "tensorflow", "keras", "scikit-learn", "nlp", "natural-language-processing",
    "computer-vision", "image-processing", "object-detection", "segmentation",
    "reinforcement-learning", "generative-ai", "transformers", "llm",
    "large-language-model", "diffusion", "gan", "vae", "autoencoder",
    "classification", "regression", "clustering", "data-science",
    "kaggle", "model-training", "neural-networks", "convolutional-neural-network",
    "recurrent-neural-network", "lstm", "gru", "attention-mechanism",
    "bert", "gpt", "stable-diffusion", "yolo", "resnet", "vgg",
    "image-classification", "semantic-segmentation", "instance-segmentation",
    "face-recognition", "speech-recognition", "audio-processing",
    "time-series", "forecasting", "anomaly-detection", "recommendation-system",
    "embeddings", "feature-extraction", "transfer-learning", "fine-tuning",
    "hyperparameter-tuning", "model-optimization", "quantization",
    "onnx", "tensorrt", "model-compression", "pruning",
    "active-learning", "semi-supervised-learning", "self-supervised-learning",
    "meta-learning", "few-shot-learning", "zero-shot-learning",
    "graph-neural-network", "gnn", "knowledge-graph", "multimodal",
    "vision-transformer", "clip", "dalle", "whisper", "chatbot",
    "text-generation", "text-classification", "sentiment-analysis",
    "named-entity-recognition", "question-answering", "summarization",
    "translation", "optical-character-recognition", "ocr",
    "pose-estimation", "tracking", "video-analysis", "3d-vision",
]
CRAWL_BROAD_TOPICS = [
    "machine-learning", "deep-learning", "artificial-intelligence",
    "pytorch", "tensorflow", "computer-vision", "nlp", "transformers",
]
CRAWL_YEARS = ["2024", "2023", "2022", "2021", "2020", "2019"]
CRAWL_CORE_TOPICS = ["machine-learning", "deep-learning", "pytorch", "tensorflow", "transformers"]
CRAWL_README_WORDS = [
    "neural network", "machine learning", "deep learning", "transformer",
    "CNN", "RNN", "LSTM", "GAN", "VAE", "reinforcement learning",
    "computer vision", "NLP", "image classification", "object detection",
]
CRAWL_LICENSES = ["mit", "apache-2.0", "gpl-3.0", "bsd-3-clause"]
CRAWL_SIZES = [">=50000", ">=20000", ">=10000", ">=5000"]
CRAWL_FILENAMES = ["train.py", "model.py", "inference.py", "dataset.py", "network.py"]
CRAWL_RECENT_DATE = "2023-01-01"
CRAWL_RECENT_TOPICS = 15
CRAWL_ARCHIVED = [("machine-learning", "ML"), ("deep-learning", "DL")]

# --- Fixed values: query and description of the nine crawl query families -------------
CRAWL_TEMPLATES = {
    "topic": ("language:python topic:{topic} stars:{stars}", "ML/DL: {topic} ({label} stars, {sort_label})"),
    "recent": (
        "language:python topic:{topic} stars:{stars} pushed:>{date}",
        "Recent: {topic} ({label} stars, updated 2023+)",
    ),
    "broad": ("language:python {topic} stars:{stars}", "Broad: {topic} ({label} stars, {sort_label})"),
    "year": ("language:python {topic} stars:{stars} created:{year}", "Year {year}: {topic} ({label} stars)"),
    "readme": ('language:python "{word}" in:readme stars:{stars}', 'README: "{word}" ({label} stars)'),
    "license": (
        "language:python machine-learning stars:{stars} license:{license}",
        "License {license}: ML ({label} stars)",
    ),
    "size": ("language:python machine-learning size:{size}", "Large repos: size {size}KB ({sort_label})"),
    "filename": ("language:python filename:{filename} stars:{stars}", "Filename {filename} ({label} stars)"),
    "archived": ("language:python {topic} stars:{stars} archived:true", "Archived {short} repos ({label} stars)"),
}

# --- Fixed values: patterns -----------------------------------------------------------
RECORD_PATTERN = r'(?s)<div[^>]*search-title[^>]*>.*?href="/([^/]+/[^/"]+)"'
STARS_LABEL_PATTERN = r'aria-label="(\d+)\s+stars"'
STARS_SPAN_PATTERN = r'(?s)href="/[^"]+/stargazers"[^>]*>.*?<span[^>]*>([\d.]+[kmKM]?)</span>'
SEARCH_URL = "https://github.com/search?q={query}&type=repositories&s={sort}&o=desc&p={page}"
CLONE_URL_PREFIX = "https://github.com/"
CLONE_URL_SUFFIX = ".git"
BACKFILL_NOTE = "Processed from existing directory"
