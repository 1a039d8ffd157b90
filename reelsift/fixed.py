"""Fixed values that results depend on: word patterns, texts, defaults, formats."""

# --- fixed values: file kinds -------------------------------------------------
VIDEO_SUFFIXES = (".mp4", ".mov", ".avi", ".mkv", ".webm")

# --- fixed values: caption patterns (valid in Java, RE2 and Python) -----------
THINK_BLOCK = r"(?is)<think>.*?</think>"
THINK_TAG = r"(?i)</?think>"
FINAL_CAPTION = r"(?is)(?:final\s+)?(?:dense\s+)?caption\s*:\s*(.+)$"
CAPTION_PREFIX = r"(?i)^(?:final\s+)?(?:dense\s+)?caption\s*:\s*"
ANALYSIS_MARKER = r"(?i)\b(the user wants|frame analysis|provided frames|frame\s*\d+|bullet labels?)\b|\*\*frame"
TEXT_ARTIFACT = (
    r"(?i)\b(text overlay|overlay text|overlaid text|text is overlaid|visible text|subtitles?|"
    r"watermarks?|logo|username|handle|caption text|on-screen text|text says|words? on screen)\b"
)
INCOMPLETE_END = r"(?i)\b(with|and|or|of|in|on|at|the|a|an|to|from|while|showing)$"

# --- fixed values: prompt -----------------------------------------------------
PROMPT_HEAD = (
    "Describe this video clip for text-to-video model training. Return exactly one clean "
    "caption paragraph of 35-90 words. Do not include reasoning, frame-by-frame analysis, "
    "Markdown, bullet points, labels, quotes, or phrases like 'the user wants'. Include the "
    "main subject, action, camera motion, scene, lighting, visual style, and temporal "
    "dynamics. If visible subtitles, logos, watermarks, usernames, or text overlays appear, "
    "mention them briefly as visible text overlay. Motion estimate: "
)
PROMPT_TAIL = ". Avoid guessing identities or protected attributes."
NO_MOTION = "unknown motion"

# --- fixed values: motion and light sentences -----------------------------------
MOTION_STATIC = "Mostly static shot with minimal camera or object movement."
MOTION_MODERATE = "Moderate motion with visible object or camera movement."
MOTION_FAST = "Fast or unstable motion; inspect before using for training."
NO_FRAMES = "Video clip with unavailable visual content."
NO_MOTION_ESTIMATE = "motion not estimated"
DEFAULT_TRAINING_CAPTION = "A curated video frame."

# --- fixed values: training rows ------------------------------------------------
MOTIONS = ("static", "smooth camera pan", "fast handheld motion", "subject walking")
SCENES = ("street", "gym", "studio", "car interior")
#: (field, default, divisor) of the feature vector, in order; ``keep`` follows as 1 or 0.
FEATURES = (
    ("duration_sec", 10.0, 30.0), ("width", 512.0, 1024.0), ("height", 512.0, 1024.0), ("fps", 24.0, 60.0), ("blur_score", 100.0, 500.0),
    ("brightness", 128.0, 255.0), ("contrast_score", 40.0, 128.0), ("colorfulness_score", 40.0, 128.0), ("motion_score", 1.0, 50.0),
    ("motion_p95_score", 1.0, 100.0), ("motion_stability_score", 1.0, 1.0), ("aesthetic_score", 5.0, 10.0), ("ocr_text_area_ratio", 0.0, 1.0),
)

# --- fixed values: inference estimates --------------------------------------------
SCENARIOS = (("baseline_30_steps", 30, False, False, False), ("fast_8_steps", 8, False, False, False), ("memory_sliced_30_steps", 30, True, True, False), ("compile_8_steps", 8, False, False, True))
NOTE_ATTENTION = "attention slicing lowers VRAM with small latency overhead"
NOTE_VAE = "VAE slicing lowers decode memory"
NOTE_COMPILE = "torch.compile estimate after warmup"
NOTE_BASE = "dry-run baseline estimate"

# --- fixed values: sizes of linear heads by variant --------------------------------
HEAD_SIZES = {"vit_b_32": 512, "vit_b_16": 512, "vit_l_14": 768}

# --- fixed values: remote captioners: address, model, key, size parameter, its value, most key frames
REMOTE = {
    "openai": ("https://api.openai.com/v1/chat/completions", "gpt-4o-mini", "OPENAI_API_KEY", "max_tokens", 160, 4),
    "groq": ("https://api.groq.com/openai/v1/chat/completions", "qwen/qwen3.6-27b", "GROQ_API_KEY", "max_completion_tokens", 220, 3),
}
