"""Fixed values that must equal the warehouse being re-built.

These are data, not logic: member labels, band labels, code lists and constants
that appear in the source warehouse's tables and reports. They are listed here
plainly, in their natural order, so every module reads them from one place.
"""

# --- fixed values: member and default labels ---------------------------------
UNKNOWN = "Không xác định"          # unknown / missing attribute
NOT_APPLICABLE = "Không áp dụng"     # attribute that by nature has no value
UNKNOWN_SHORT = "Không rõ"           # unknown age group
CLUB_PREFIX = "CLB "                 # default club name: "CLB " + club_id
PLAYER_PREFIX = "Cầu thủ "           # default player name: "Cầu thủ " + player_id
INFERRED_CLUB_NAME = "CLB ngoài dữ liệu"   # clubs seen only in facts
INFERRED_CLUB_PREFIX = "CLB "
INTERNATIONAL = "International"      # country of an international competition

# special members: key -> name, per dimension
UNKNOWN_CLUB = "Không rõ CLB"
NO_CLUB = "Không thuộc CLB nào"
UNKNOWN_PLAYER = "Không rõ cầu thủ"
UNKNOWN_COMPETITION = "Không rõ giải (mã thiếu trong danh mục)"
NO_COMPETITION = "Không thuộc giải VĐQG"

# --- fixed values: source codes remapped to special members ------------------
NOT_APPLICABLE_CLUB_IDS = (123, 515, 2077, 2113)   # -> -2
UNKNOWN_CLUB_IDS = (75,)                            # -> -1
NULL_TOKENS = ("nan", "None", "null", "NULL")

# --- fixed values: ligature folding (manager names), in order ----------------
LIGATURES = (("æ", "ae"), ("Æ", "Ae"), ("œ", "oe"), ("Œ", "Oe"), ("ß", "ss"))

# --- fixed values: confederation normalisation -------------------------------
CONFEDERATION_ALIASES = (
    ("UEFA", ("EUROPA", "UEFA")),
    ("AFC", ("ASIEN", "AFC")),
    ("CAF", ("AFRIKA", "CAF")),
    ("Americas", ("AMERIKA", "AMERICAS", "CONCACAF", "CONMEBOL")),
    ("OFC", ("OFC",)),
    ("FIFA", ("FIFA",)),
)

# --- fixed values: transfer fee status and band ------------------------------
FEE_UNDISCLOSED = "Không công bố"
FEE_FREE = "Miễn phí hoặc cho mượn"
FEE_PAID = "Có phí"
FEE_BAND_NA = NOT_APPLICABLE
FEE_BANDS = ("< 1 triệu", "1-10 triệu", "10-50 triệu", "> 50 triệu")
# transfer type junk dimension: key, fee_status, fee_band
TRANSFER_TYPES = (
    (-1, UNKNOWN, UNKNOWN),
    (1, FEE_UNDISCLOSED, FEE_BAND_NA),
    (2, FEE_FREE, FEE_BAND_NA),
    (3, FEE_PAID, "< 1 triệu"),
    (4, FEE_PAID, "1-10 triệu"),
    (5, FEE_PAID, "10-50 triệu"),
    (6, FEE_PAID, "> 50 triệu"),
)

# --- fixed values: attribute bands (label per upper cut) ---------------------
STADIUM_BANDS = ("< 20.000", "20.000-39.999", "40.000-59.999", ">= 60.000")       # cuts 20000/40000/60000
ATTENDANCE_BANDS = ("< 10.000", "10.000-29.999", "30.000-59.999", ">= 60.000")    # cuts 10000/30000/60000
HEIGHT_BANDS = ("< 170 cm", "170-179", "180-189", ">= 190")                       # valid 150..220
CAPS_BANDS = ("Chưa khoác áo", "1-10", "11-50", "> 50")
ROUND_TYPES = ("Matchday", "Group stage", "Final", "Knockout")

# age groups of the age dimension (label, sort order); unknown = key 0 -> order 9
AGE_GROUPS = (("Dưới 18", 1), ("18-21", 2), ("22-24", 3), ("25-28", 4), ("29-31", 5), ("32+", 6))
# age brackets of the valuation-growth question
AGE_BRACKETS = (
    "U21 (Tài năng trẻ)",
    "21 - 25 tuổi (Đang phát triển)",
    "26 - 29 tuổi (Đỉnh cao phong độ)",
    "30+ tuổi (Kinh nghiệm/Lão tướng)",
)

# --- fixed values: report labels ----------------------------------------------
STRATEGY_LABELS = (
    "Chấp nhận chi đậm vượt giá thị trường",    # premium > 20 M
    "Mua được giá hời/dưới giá thị trường",     # premium < -10 M
    "Giao dịch sát giá trị định giá",           # otherwise
)
CUBE_ALL_SEASONS = "TẤT CẢ MÙA GIẢI"
CUBE_ALL_STATUSES = "TẤT CẢ TRẠNG THÁI"
CUBE_ALL_BANDS = "TẤT CẢ PHÂN KHÚC"
ROLLUP_GRAND_TOTAL = "TỔNG CHUNG"
ROLLUP_CONFED_TOTAL = "(Tổng liên đoàn)"
ROLLUP_NO_COUNTRY = "(Không gắn quốc gia)"
ROLLUP_COUNTRY_TOTAL = "(Tổng quốc gia)"
GSETS_BY_REGION = "Theo khu vực CLB mua"
GSETS_BY_POSITION = "Theo vị trí"
GSETS_TOTAL = "Tổng chung"
GSETS_ALL = "Tất cả"
YOUTH_LABELS = ("Đội trẻ (<18)", "Chuyên nghiệp", "Không rõ tuổi")

# --- fixed values: constants --------------------------------------------------
BUDGET_EUR = 100_000_000
DATE_DIM_START = "1990-01-01"
DATE_DIM_END = "2030-12-31"
SEASON_FIRST, SEASON_LAST = 1990, 2030
SCD_OPEN_END = "9999-12-31"
SCD_FIRST_START = "1900-01-01"
MINUTES_MAX = 130
