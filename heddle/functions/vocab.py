"""Fixed vocabularies of the listing domain."""

# Spellings of provinces, without accents or prefix, and their codes.
PROVINCES = {
    "ho chi minh": "HCM",
    "hcm": "HCM",
    "sai gon": "HCM",
    "saigon": "HCM",
    "ha noi": "HN",
    "hanoi": "HN",
    "da nang": "DN",
    "danang": "DN",
    "binh duong": "BD",
    "dong nai": "DNA",
    "can tho": "CT",
}
PROVINCE_CODES = ("HCM", "HN", "DN", "BD", "DNA", "CT")
FURNISHING_LEVELS = ("none", "basic", "full", "unknown")
PROPERTY_TYPES = ("apartment", "house", "room", "studio", "shophouse", "townhouse", "other")

# Furnishing by source and the source's words.
FURNISHING = {
    "batdongsan": {
        "Đầy đủ": "full",
        "Đầy đủ nội thất": "full",
        "Nội thất đầy đủ": "full",
        "Full nội thất": "full",
        "Cao cấp": "full",
        "Nội thất cao cấp": "full",
        "Cơ bản": "basic",
        "Nội thất cơ bản": "basic",
        "Một phần": "basic",
        "Không nội thất": "none",
        "Không có nội thất": "none",
        "Nhà trống": "none",
        "Bàn giao thô": "none",
    },
    "phongtro123": {"full": "full", "basic": "basic", "none": "none"},
    "mogi": {
        "Đầy đủ": "full",
        "Đầy đủ nội thất": "full",
        "Nội thất đầy đủ": "full",
        "Cao cấp": "full",
        "Nội thất cao cấp": "full",
        "Cơ bản": "basic",
        "Nội thất cơ bản": "basic",
        "Một phần": "basic",
        "Không có": "none",
        "Không nội thất": "none",
        "Nhà trống": "none",
    },
    "nhatot": {
        "Nội thất đầy đủ": "full",
        "Đầy đủ": "full",
        "Nội thất cao cấp": "full",
        "Nội thất cơ bản": "basic",
        "Cơ bản": "basic",
        "Không nội thất": "none",
        "Nhà trống": "none",
    },
}

# Property type by source and the source's words.
PROPERTY_TYPE = {
    "batdongsan": {
        "Cho thuê chung cư mini, căn hộ dịch vụ": "apartment",
        "Cho thuê căn hộ chung cư": "apartment",
        "Cho thuê phòng trọ": "room",
        "Cho thuê nhà riêng": "house",
        "Cho thuê nhà mặt phố": "shophouse",
        "Cho thuê nhà trọ, phòng trọ": "room",
        "chung cư mini": "apartment",
        "căn hộ dịch vụ": "apartment",
        "căn hộ chung cư": "apartment",
        "phòng trọ": "room",
        "nhà riêng": "house",
        "nhà mặt phố": "shophouse",
        "nhà trọ": "room",
    },
    "phongtro123": {
        "Cho thuê căn hộ": "apartment",
        "Cho thuê phòng trọ": "room",
        "Cho thuê nhà nguyên căn": "house",
        "Nhà ở ghép": "room",
        "Cho thuê mặt bằng": "shophouse",
        "Apartment": "apartment",
        "căn hộ": "apartment",
        "phòng trọ": "room",
        "nhà nguyên căn": "house",
    },
    "mogi": {
        "Nhà trọ": "room",
        "Căn hộ": "apartment",
        "Căn hộ chung cư": "apartment",
        "Căn hộ dịch vụ": "apartment",
        "Nhà nguyên căn": "house",
        "Nhà mặt tiền": "shophouse",
        "Mặt bằng": "shophouse",
        "Phòng trọ": "room",
        "Biệt thự": "house",
    },
    "nhatot": {
        "Căn hộ/Chung cư": "apartment",
        "Căn hộ dịch vụ, mini": "apartment",
        "Nhà riêng": "house",
        "Nhà mặt phố": "shophouse",
        "Nhà phố thương mại": "shophouse",
        "Phòng trọ, nhà trọ": "room",
        "Nhà trọ, phòng trọ": "room",
    },
}

# Phrases of a page whose listing was taken down.
REMOVAL_PHRASES = (
    "tin đăng không tồn tại",
    "đã bị gỡ",
    "không tìm thấy",
    "hết hạn",
    "tin đã hết hạn",
    "bài đăng không tồn tại",
    "nội dung đã bị xóa",
    "đã được gỡ bỏ",
)

# Abbreviations that listings use.
ABBREVIATIONS = {"pt": "phòng trọ", "ch": "căn hộ", "cc": "chung cư", "nnc": "nhà nguyên căn", "nt": "nội thất", "wc": "nhà vệ sinh", "pn": "phòng ngủ"}

#: Words that flag an amenity, by the flag's name.
AMENITIES = {
    "air_conditioner": "máy lạnh|điều hòa",
    "wifi": "wifi|internet",
    "parking": "giữ xe|chỗ để xe|parking",
    "lift": "thang máy",
    "balcony": "ban công",
    "mezzanine": "gác lửng|có gác",
    "kitchen": "bếp",
    "washer": "máy giặt",
    "fridge": "tủ lạnh",
    "security": "bảo vệ|an ninh",
    "free_hours": "giờ giấc tự do",
    "pool": "hồ bơi",
    "private_bathroom": "wc riêng|vệ sinh riêng|toilet riêng",
    "cooking": "nấu ăn|được nấu",
    "water_heater": "nóng lạnh|bình nóng",
    "bed": "giường",
    "wardrobe": "tủ quần áo",
    "television": "tivi|truyền hình",
    "window": "cửa sổ",
    "terrace": "sân thượng",
    "garden": "sân vườn",
    "camera": "camera",
    "fingerprint_lock": "vân tay",
    "pets": "thú cưng|nuôi chó|nuôi mèo",
    "gym": "phòng gym|gym",
}
