"""Row shapes of the inputs, as DDL text accepted wherever Spark takes a schema."""

# Column names and types of the input records.
CARS = (
    "Name STRING, Miles_per_Gallon DOUBLE, Cylinders BIGINT, Displacement DOUBLE, "
    "Horsepower BIGINT, Weight_in_lbs BIGINT, Acceleration DOUBLE, Year STRING, Origin STRING"
)
STOCKS = "company STRING, date DATE, value DOUBLE"
PURCHASES = "id STRING, time TIMESTAMP, item STRING, quantity INT"
BANDS = "hometown STRING, id BIGINT, name STRING, year BIGINT"
GUITAR_PLAYERS = "band BIGINT, guitars ARRAY<BIGINT>, id BIGINT, name STRING"
LINES = "value STRING"
KAFKA_ROW = (
    "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, "
    "timestamp TIMESTAMP, timestampType INT"
)

# Text formats of the inputs.
STOCK_DATE_FORMAT = "MMM d yyyy"
UNDEFINED_KEY = "undefined"
