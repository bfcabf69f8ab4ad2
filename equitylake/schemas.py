"""Schemas of all data sets, as DDL. Sources never infer theirs."""

PRICE_HISTORY = "symbol string, date date, open bigint, high bigint, low bigint, close bigint, volume double, createdAt timestamp, updatedAt timestamp"
OHLCV_RAW = "TIME string, OPEN string, HIGH string, LOW string, CLOSE string, VOLUME string"
STOCKS = "symbol string, name string, sectorName string, isETF boolean, isDebt boolean, marketCap double, faceValue double, isActive boolean, createdAt timestamp"
SYMBOL_FEED = "symbol string, name string, sectorName string, isETF boolean, isDebt boolean"
ANNOUNCEMENT = "symbol string, name string, dividend double, bonus string, right string, x_date date, sector string, announcement_type array<string>"
METADATA = "struct<source:string,url:string,notes:string>"
DIVIDEND = f"symbol string, amountPerShare double, faceValue double, exDate date, recordDate date, payDate date, status string, type string, yield double, metadata {METADATA}, createdAt timestamp, updatedAt timestamp"
BONUS = f"symbol string, bonusPercentage double, bonusType string, exDate date, status string, metadata {METADATA}, createdAt timestamp, updatedAt timestamp"
MARKET_WATCH = "symbol string, name string, sector_code string, indices array<string>, ldcp double, open double, high double, low double, price double, change double, change_pct double, change_direction string, volume bigint"
QUOTE = (
    "symbol string, name string, sector string, price double, change double, change_pct double, change_direction string, as_of timestamp, "
    "open double, high double, low double, volume bigint, circuit_breaker_low double, circuit_breaker_high double, day_range_low double, "
    "day_range_high double, ask_price double, ask_volume bigint, bid_price double, bid_volume bigint, ldcp double, var double, haircut double, "
    "pe_ratio_ttm double, scraped_at timestamp, source_url string"
)
MISSING_REPORT = "map<string,array<struct<start:string,end:string>>>"
GAP_REPORT = "map<string,array<struct<start:string,end:string,missing_trading_days:int,last_actual_date:string>>>"
FAILED_INTERVAL = "symbol string, interval_start date, interval_end date, reason string, createdAt timestamp, updatedAt timestamp"
