"""Fixed values.

These must be equal to the values used by the data files and tables this
library replaces; everything else in the library is parameterised on them.
"""

# URI forms and key text
TRACK_URI_PREFIX = "spotify:track:"
EPISODE_URI_PREFIX = "spotify:episode:"
SURROGATE_NULL_TEXT = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"
ARTIST_FALLBACK_PREFIX = "ext_artist_"
ARTIST_FALLBACK_LENGTH = 18
ALBUM_FALLBACK_PREFIX = "ext_album_"
ALBUM_FALLBACK_LENGTH = 19
UNKNOWN_NAME = "unknown"
NATIVE_ID_LENGTH = 22

# Source tags
SOURCE_API = "api"
SOURCE_EXPORT = "extended_history"

# thresholds
MIN_PLAY_MS = 30000
SESSION_GAP_MINUTES = 30
LOCAL_OFFSET_HOURS = 6
PLAYLIST_SLOTS = 5
MAX_STAGED_MS = 86400000
MAX_PLAY_MS = 3600000

# Mood labels and cut points (track level, playlist level)
MOOD_HAPPY_ENERGETIC = "Happy & Energetic"
MOOD_HAPPY_CALM = "Happy & Calm"
MOOD_SAD_ENERGETIC = "Sad & Energetic"
MOOD_SAD_CALM = "Sad & Calm"
MOOD_NEUTRAL = "Neutral"
TRACK_MOOD_HIGH = 0.7
TRACK_MOOD_LOW = 0.4
PLAYLIST_MOOD_HIGH = 0.6
PLAYLIST_MOOD_LOW = 0.4

# Names of landing files
HISTORY_FILE_GLOB = "Streaming_History_Audio_*.json"
HISTORY_FILE_GLOB_ALT = "endsong_*.json"

# Freshness limits in hours, per raw table (warn, error)
FRESHNESS_DEFAULT_HOURS = (24, 48)
FRESHNESS_PLAYS_HOURS = (6, 24)
