"""Constants that define the tree's semantics."""

# Fixed values of the format.
WORLD_CENTER = (0.0, 0.0, 0.0)
WORLD_HALF_SIZE_PC = 200_000.0
MORTON_BITS = 21
DEFAULT_MAX_LEVEL = 13
DEFAULT_DEEP_SHARD_FROM_LEVEL = 99
DEFAULT_MAG_VIS = 6.5
FAINT_STOP = 25.0
UNKNOWN_MAG, UNKNOWN_TEFF = 99.0, 5800.0
TEFF_LO, TEFF_HI, TEFF_UNKNOWN_CODE = 2000.0, 50_000.0, 255
DISTANCE_FLOOR_PC = 1e-6
COALESCE_GAP_BYTES = 64 * 1024
LEVELS_PER_SHARD = 5
FILE_HEAD_BYTES = 192  # header and descriptor; the first payload's offset
SHARD_HEADER_BYTES, NODE_BYTES, FRONTIER_BYTES, STAR_BYTES = 80, 20, 8, 16
HAS_PAYLOAD, HAS_CHILDREN, IS_FRONTIER = 1, 2, 4
IDENTIFIER_FIELDS = ("gaia_source_id", "hip_id", "hd", "bayer", "flamsteed", "constellation", "proper_name")
INTEGER_FIELDS = ("gaia_source_id", "hip_id", "hd", "flamsteed")
