"""Word lists, look-up tables and constants that results depend on."""

# fmt: off
#: Text that counts as true, after trimming and lower-casing ("1.0" is what a 0/1 column with gaps becomes).
TRUE_WORDS = ("true", "1", "1.0", "yes", "y", "t")
#: Band names, and prefixes of band fields that mean them.
BANDS = ("band1", "band2", "band3", "band4")
BAND_PREFIXES = {"1-150": "band1", "151-500": "band2", "501-800": "band3", "801-1025": "band4"}
#: File extensions that a source may keep, and extensions of decoded formats.
URL_EXTENSIONS = (".jpg", ".jpeg", ".png", ".webp")
FORMAT_EXTENSIONS = {"JPEG": ".jpg", "PNG": ".png", "WEBP": ".webp"}
SHARD_EXTENSIONS = (".jpg", ".jpeg", ".png", ".webp", ".bmp")
#: Tags whose score marks unsafe content.
UNSAFE_TAGS = ("nude", "sex", "pussy", "penis", "breasts", "nipples", "cum", "vagina")
#: Sizes of the resize policy.
TARGET_MIN, CAP_MIN, CAP_LONG = 1024, 2048, 4096
#: Columns of the record ledger.
LEDGER_COLUMNS = ("ts", "scrape_run_id", "image_id", "species", "rank", "band", "query", "source_url", "source_domain", "path_raw", "fmt", "w", "h", "content_type", "safe", "hl", "gl")
#: Columns of the audit log of dropped records.
DROP_COLUMNS = ("ts", "image_id", "url", "stage", "drop_reason", "nsfw_tags", "nsfw_score", "threshold", "band", "species", "path_raw")
#: Names that stand for others, and names that reject a record.
ALIASES = {
    "tapufini": "tapu_fini", "tapulele": "tapu_lele", "coffagrigus": "cofagrigus", "giraffarig": "girafarig",
    "nidoran_f": "nidoran_female", "nidoran_m": "nidoran_male", "alolan_ninetales": "ninetales", "alolan_raichu": "raichu",
    "alolan_marowak": "marowak", "alolan_sandshrew": "sandshrew", "alolan_sandslash": "sandslash", "galarian_ponyta": "ponyta",
    "paldean_wooper": "wooper", "hisuian_arcanine": "arcanine", "urshifu_rapid_strike": "urshifu", "hoopa_unbound": "hoopa", "alolan_vulpix": "vulpix",
}
DENIED = (
    "pokemon", "original_pokemon", "unknown", "unknown_pokemon", "unidentified_pokemon", "unknown_fakemon", "unknown_pok_mon",
    "dragon_like_1", "dragon_like_2", "serpentine_pokemon", "wild_duck", "fakemon", "fan_made", "fanmade_pokemon", "fan_made_pokemon",
    "original_fakemon", "original_fakemon_big", "original_fakemon_small", "fan_made_jelly_large", "fan_made_jelly_small",
    "fan_monster_large", "fan_monster_small", "fanmon_blue", "fanmon_red", "ashmish", "cinnapup", "dread_dragoona", "kamitsu_orochi",
    "fakemon_bloombird", "fakemon_fire_crocodile", "fakemon_gem_turtle", "fakemon_sprout", "nidoran",
)
#: Keys of the tag document that hold the names, and the other facets.
NAME_KEY, PLAIN_NAME_KEY = "Pokémon", "pokemon"
SNAKE_FACETS = ("shiny_pokemon", "pose", "actions", "outfit", "props", "environment", "biome", "time_of_day", "weather", "background", "characteristics")
#: Order of the facets in a composed caption.
CAPTION_FACETS = ("composition", "art_style", "actions", "pose", "environment", "biome", "time_of_day", "weather", "background", "outfit", "props", "characteristics")
#: Former names of boolean keys.
FORMER_KEYS = {"shiny_presence": ("shiny", "shiny_present"), "trainer_presence": ("trainer_present",)}
#: Closed vocabularies.
ART_STYLES = ("anime", "chibi", "pixel_art", "3d_render", "watercolor", "sketch", "lineart", "painterly", "cel_shade", "lineless", "realistic", "semi_realistic")
COMPOSITIONS = (
    "close_up", "extreme_close_up", "portrait", "bust", "half_body", "three_quarter_view", "full_body", "wide_shot", "long_shot",
    "establishing_shot", "centered", "rule_of_thirds", "symmetrical", "negative_space", "dynamic_angle", "dutch_angle", "low_angle",
    "high_angle", "top_down", "isometric", "over_the_shoulder", "profile_view", "back_view", "front_view", "panoramic", "macro", "silhouette",
)
#: Forms that become a prefix of the name, and the suffixes of mega forms.
FORM_PREFIXES = {
    "alolan": "alolan", "galarian": "galarian", "hisui": "hisui", "hisuian": "hisui", "paldean": "paldean", "totem": "totem", "origin": "origin",
    "gigantamax": "gigantamax", "primal": "primal", "shadow": "shadow", "apex": "apex", "female": "female", "male": "male", "therian": "therian",
    "incarnate": "incarnate", "sky": "sky", "black": "black", "white": "white",
}
MEGA_SUFFIXES = {"mega": "", "mega_x": " x", "mega_y": " y"}
# fmt: on
