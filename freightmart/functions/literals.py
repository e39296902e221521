"""They decide results and therefore stay exactly as the business uses them."""

# The identifier meaning "no reference" and the earliest date taken as real.
ZERO_REF = "00000000-0000-0000-0000-000000000000"
REAL_DATE_FLOOR = "2011-01-01"

# Warehouse name patterns, first match wins.
FORMAT_PATTERNS = [("%4%PL%", "4PL")]
FORMAT_OTHER = "ОХ"
OWNER_PATTERNS = [("%АБЛ%", "АБЛ"), ("%Рэйл%", "АБЛ"), ("%Делоникс%", "АБЛ"), ("%ТМХ-И%", "АБЛ")]
OWNER_NO_USAGE = "ЖДРМ"
OWNER_OTHER = "ЛТС"
KIND_PATTERNS = [("%СЛД-%", "СЛД"), ("%СО%", "СО"), ("%СУ%", "СУ"), ("%ЦС%", "ЦС"), ("%ОП%", "ЦС")]
KIND_OTHER = "ЗАВОД"
KIND_PATTERNS_SLA = [("%СЛД-%", "СЛД"), ("%СО%", "СО"), ("%СУ%", "СУ"), ("%ЦС %", "ЦС"), ("%ОП%", "ЦС")]
KIND_OTHER_SLA = "ЖДРМ"
DEFAULT_PERSON = "Заводы ЖДРМ"

# Movement valuation.
ASSIGNMENT_CORRECTION_TYPE = "00000348"
BUYOUT_PATTERN = "%ыкуп%"
BUYOUT = "Выкуп"
FREE_STOCK = "Свободные остатки"

# Price list exclusions.
CONSOLIDATION_BRANCH = "Консолидация"
CENTRAL_KIND = "ЦС"
PLACEHOLDER_PRICES = [0, 1]

# Yes / no texts.
YES = "Да"
NO = "Нет"
YES_CAPS = "ДА"
NO_CAPS = "НЕТ"
AGREED = "Согласован"

# Status groups.
FINAL_DELIVERED = ["Доставлен", "Доставлено", "Выполнено", "Выполнена"]
FINAL_ACTIVE = [
    "Доставлен", "Отгружен", "В работе", "В пути", "Водитель назначен",
    "Доставлено", "Выполнено", "Выполнена",
]
COST_STATUSES = [
    "Отгружен", "В работе", "В пути", "Перевозчик назначен", "Доставлено", "Выполнено", "Согласовано",
]
TRACK_DONE = ["Выполнена", "Доставлен", "Доставлено"]
TRACK_CANCELLED = ["Отменено заказчиком", "Отмена"]
TRACK_ROAD = ["Отгружен", "В пути"]
TRACK_WAITING = [
    "Новая", "В работе", "Отправлен на доработку", "На корректировке", "На согласовании",
    "Не согласовано", "Согласовано", "На оценке", "На редукционе", "Водитель назначен",
    "Просрочено", "Прикрепляет ТС",
]
CONSOLIDATION = "Консолидация"
FROM_WAREHOUSE = "Консолидация - со склада - "
CANCELLED = "Отмена"
DELIVERED = "Доставлен"
CANCELLED_BY_CUSTOMER = "Отменено заказчиком"
DIRECT_TRIP = "Прямой рейс"
VIA_WAREHOUSE = "Через склад"
NO_DATA = "Нет данных"
OTHER = "Прочие"

# Platform status codes and their names; transport codes go first.
TRANSPORT_STATUS = [
    (["SHIPPING"], "В пути"),
    (["SHIPPED"], "Доставлено"),
    (["SHIPPED_AND_CONFIRMED"], "Выполнено"),
    (["DRIVER_ASSIGNED"], "Водитель назначен"),
    (["READY_FOR_ASSIGNMENT"], "Прикрепляет ТС"),
    (["CANCELED"], "Отмена"),
]
ORDER_STATUS = [
    (["CANCELED"], "Отмена"),
    (["DRAFT", "ON_APPROVED"], "Черновик"),
    (["ROUTING", "ROUTED"], "Консолидация"),
    (["ON_CONTROL"], "Контроль"),
    (["APPROVED", "APPROVING", "REVISING", "CREATED"], "Новая"),
    (["EXPIRED"], "Просрочено"),
    (["SHIPPED"], "Доставлено"),
    (["DRIVER_ASSIGNED"], "Водитель назначен"),
    (["SHIPPING"], "В пути"),
    (["READY_FOR_ASSIGNMENT"], "Прикрепляет ТС"),
    (["SHIPPED_AND_CONFIRMED"], "Выполнена"),
]
REDUCTION_STATUS = "На редукционе"
BID_TYPES = [("TENDER", "Тендер"), ("REDUCTION", "Редукцион")]
NO_BIDS = "Без торгов"
FIXED_TARIFF = "FIXED"
DELIVERY_FIXED = "Автотранспорт"
DELIVERY_HOURLY = "Автотранспорт (руб/час)"

# Numbers left out of the platform side, and the platform's own carrier.
PLATFORM_SKIPPED_PREFIXES = ["ABS", "ABL", "ALS", "WMS"]
OWN_CARRIER_TAX_ID = "7706452837"
VIRTUAL_DRIVER_PATTERN = "Водитель Виртуальный%"
VIRTUAL_DRIVER_EXACT = "Виртуальный Водитель Водитель"
PLATFORM_CARRIER = 'ООО "ИКСПЛАНЕТ.РУ"'
DISPATCH_PLACE = "УПП"
PLATFORM_PLACE = "xPlanet"
EXPORT_PRICE_TYPE = "826382f2-e959-11e6-80e9-00505601119a"
SHIPPED_REQUEST_STATUS = "687015be-bd65-4e9a-a184-c21a3a836ee8"
HOME_COUNTRY = "RU"
VAT_DIVISOR = "1.2"
TRAWL = "Трал"

# Where a request is now.
PLACE_CANCELLED = "Заявка отменена"
PLACE_UNKNOWN = "Не опред."
STAGE_LOADING_PROBLEM = "проблема при погрузке"
STAGE_CONSOLIDATION = "на складе консолидации"
STAGE_START = "в начальном пункте"
STAGE_CANCELLED = "заявка отменена"
STAGE_TO_CUSTOMER = "в пути до потребителя"
STAGE_TO_CONSOLIDATION = "в пути до консолидации"
STAGE_DONE = "доставлено"
STAGE_UNKNOWN = "не опред."
NEW_STATUSES = ["Новая", "Согласовано"]

# Loading addresses that are consolidation warehouses.
CONSOLIDATION_ADDRESSES = [
    ("142435, Московская обл, Ногинск г, Кудиново с, Центральная ул, дом 23", "ЦС Кудиново"),
    ("142435, Московская обл., Богородский гор.округ, с. Кудиново, ул. Центральная, 23", "ЦС Кудиново"),
    ("142435, Московская обл, г Ногинск, с Кудиново, ул Центральная, д. 23", "ЦС Кудиново"),
    ("Московская область, городской округ Богородский, село Кудиново, улица Центральная, дом 23", "ЦС Кудиново"),
    ("Московская область, Ногинск город, село Кудиново, улица Центральная, дом 23", "ЦС Кудиново"),
    ("Россия, Московская область, Богородский городской округ, село Кудиново, Центральная улица, 23", "ЦС Кудиново"),
    ("623700, Свердловская обл, Березовский г, Западная промзона тер.", "ЦС Екатеринбург"),
    ("623700, Свердловская обл, Березовский г, Западная промзона тер. 13А", "ЦС Екатеринбург"),
    ("623700, Свердловская обл, г Березовский, тер. Западная промзона, стр. 13а", "ЦС Екатеринбург"),
    ("623700, Свердловская обл, г Березовский, тер. Западная промзона, стр. 13 корп. А", "ЦС Екатеринбург"),
    ("Свердловская обл, Березовский г, Западная промзона тер.", "ЦС Екатеринбург"),
    ("Свердловская обл, Березовский г, Западная промзона тер., строение 13а", "ЦС Екатеринбург"),
    ("630068, Новосибирская обл, г Новосибирск, ул Подбельского, д. 51", "ЦС Новосибирск"),
    ("630068, Новосибирская обл, Новосибирск г, Подбельского ул, дом № 51", "ЦС Новосибирск"),
    ("Новосибирская область, Россия, Новосибирск, улица Подбельского, 51", "ЦС Новосибирск"),
    ("Новосибирская обл, городской округ город Новосибирск, Новосибирск г, Инская ст, Подбельского  ул., 51",
     "ЦС Новосибирск"),
    ("Россия, Новосибирская область, Новосибирск, улица Подбельского", "ЦС Новосибирск"),
    ("344016, Ростовская обл, Ростов-на-Дону г, 1-й Машиностроительный пер, дом 3в", "ЦС Ростов-на-Дону"),
    ("РОССИЯ, 344016, Ростовская обл, г Ростов-на-Дону, пер 1-й Машиностроительный, д. 3в", "ЦС Ростов-на-Дону"),
    ("Ростовская область, 344016, г. Ростов-на-Дону, Советский район, пер. 1-й Машиностроительный, 3в",
     "ЦС Ростов-на-Дону"),
    ("Ростовская область, Россия, Ростов-на-Дону, 1-й Машиностроительный переулок, 3", "ЦС Ростов-на-Дону"),
    ("Ростовская область, Россия, Ростов-на-Дону, 1-й Машиностроительный переулок, 3А", "ЦС Ростов-на-Дону"),
    ("Ростовская область, Россия, Ростов-на-Дону, 1-й Машиностроительный переулок, 3В", "ЦС Ростов-на-Дону"),
    ("Ростовская область, Россия, Ростов-на-Дону, Машиностроительный переулок, 3", "ЦС Ростов-на-Дону"),
    ("Ростовская область, Россия, Ростов-на-Дону, Машиностроительный переулок, 3В", "ЦС Ростов-на-Дону"),
]

# Dimension (m) from which a cargo counts as at least this weight class (t).
DIMENSION_CLASSES = [("13.61", "40"), ("8.01", "20"), ("6.01", "10"), ("5.01", "5"), ("4.01", "3")]
SMALLEST_WEIGHT = "0.001"

# Trailer classes (t up to), and the divisor of each route type.
TRAILER_CLASSES = [("1.5", "1,5 т"), ("3.5", "3,5 т"), ("5", "5 т"), ("10", "10 т"), ("24", "20 т")]
ROUTE_DIVISORS = [("STANDARD", 1), ("CIRCULAR", 2), ("COMPLEX", 3)]
LONG_CARGO_M = 15
LONG_CARGO_MIN_T = 20
WEIGHT_CATEGORIES = [("1.5", "1.5 т."), ("3.5", "3 т."), ("5.5", "5 т."), ("10.5", "10 т."), ("20.5", "20 т.")]
WEIGHT_CATEGORY_TOP = "20+ т."

# Work schedules as opening minute, closing minute, minutes off per day.
SCHEDULES = [
    ("Круглосуточно, 7 дней в неделю", 0, 1440, 0),
    ("07:00-19:00, 7 дней в неделю", 420, 1140, 720),
    ("08:00-16:12, 7 дней в неделю", 480, 972, 948),
    ("08:00-17:00, 7 дней в неделю", 480, 1020, 900),
    ("08:00-20:00, 7 дней в неделю", 480, 1200, 720),
    ("09:00-21:00, 7 дней в неделю", 540, 1260, 720),
    ("08:00-16:30, 5 дней в неделю", 480, 990, 930),
    ("08:00-17:00, 5 дней в неделю", 480, 1020, 900),
]
SLA_MINUTES = 420
SLA_SHIPPED = "Отгружен"
SLA_IN_WORK = "В работе"
SLA_IN_TIME = "Без нарушения сроков"
SLA_LATE = "C нарушением сроков"

# Carrier rating.
FAR_EAST_REGIONS = ["1", "3", "14", "19", "24", "25", "27", "28", "38", "49", "65", "75", "79"]
LOST_STATUSES = ["CANCELED", "EXPIRED"]
COMPLEX_ROUTE = "COMPLEX"
OWN_VEHICLE = "OWN"
CARRIER_CANCELLER = "CARRIER"
DRIVER_APP = "driver-service"

# Stock series texts that mean "no series", and the text a series is cut at.
SERIES_NONE_LEFT = ["%Без%", "%б/н%"]
SERIES_NONE_RIGHT = ["%б/н%", "%Без%Серии%", "%Без%Номера%"]
SERIES_CUT = " от"

# Item reference.
ITEM_CODE_WIDTH = 9
WEIGHT_VOLUME_FACTOR = 350

# Columns never used for relations.
RELATION_SKIPPED_COLUMNS = ["roditel", "imya_predopredelennykh_dannykh"]

# Document kinds of the movement register that are checked.
CHECKED_MOVEMENTS = [
    "Перемещение товаров", "Производство без заказа", "Поступление товаров на склад",
    "Поступление сырья от давальца", "Передача давальцу", "Внутреннее потребление товаров",
    "Отгрузка товаров с хранения",
]
