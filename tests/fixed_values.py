"""A public monthly series and the results published for it."""

# Monthly airline passengers in thousands, 1949-01 to 1960-12 (Box and Jenkins).
PASSENGERS = [
    112, 118, 132, 129, 121, 135, 148, 148, 136, 119, 104, 118,
    115, 126, 141, 135, 125, 149, 170, 170, 158, 133, 114, 140,
    145, 150, 178, 163, 172, 178, 199, 199, 184, 162, 146, 166,
    171, 180, 193, 181, 183, 218, 230, 242, 209, 191, 172, 194,
    196, 196, 236, 235, 229, 243, 264, 272, 237, 211, 180, 201,
    204, 188, 235, 227, 234, 264, 302, 293, 259, 229, 203, 229,
    242, 233, 267, 269, 270, 315, 364, 347, 312, 274, 237, 278,
    284, 277, 317, 313, 318, 374, 413, 405, 355, 306, 271, 306,
    315, 301, 356, 348, 355, 422, 465, 467, 404, 347, 305, 336,
    340, 318, 362, 348, 363, 435, 491, 505, 404, 359, 310, 337,
    360, 342, 406, 396, 420, 472, 548, 559, 463, 407, 362, 405,
    417, 391, 419, 461, 472, 535, 622, 606, 508, 461, 390, 432,
]

# Test metrics of the rule-based forecasts: MAE, RMSE, MAPE in percent.
BASELINE_METRICS = {
    "Naive": (46.364, 53.725, 10.08),
    "MovingAvg-12": (57.621, 76.996, 11.57),
    "SeasonalNaive-12": (49.909, 51.783, 10.91),
    "LinearTrend": (60.163, 84.917, 11.68),
}

# Published forecasts of the best network, 1959-03 to 1960-12, as review input.
PUBLISHED_FORECASTS = [
    347.629, 419.151, 417.795, 448.115, 498.357, 519.73, 476.519, 389.43,
    368.854, 371.029, 427.418, 425.848, 391.511, 424.949, 475.595, 494.972,
    562.094, 597.363, 515.898, 413.531, 386.429, 356.89,
]
PUBLISHED_METRICS = (28.339, 34.931, 6.12)
PUBLISHED_THRESHOLD = 58.973
PUBLISHED_FLAGS = ["1960-07", "1960-12"]

# Test RMSE and order of all ten published configurations.
PUBLISHED_BOARD = [
    ("Baseline", "Naive", 0, 46.364, 53.725, 10.08),
    ("Baseline", "MovingAvg-12", 1, 57.621, 76.996, 11.57),
    ("Baseline", "SeasonalNaive-12", 2, 49.909, 51.783, 10.91),
    ("Baseline", "LinearTrend", 3, 60.163, 84.917, 11.68),
    ("RNN - no differencing", "LSTM", 4, 82.611, 91.364, 17.32),
    ("RNN - no differencing", "GRU", 5, 79.301, 90.717, 16.58),
    ("RNN - no differencing", "BiLSTM", 6, 66.373, 77.76, 13.56),
    ("RNN - differencing", "LSTM", 7, 37.721, 47.355, 8.08),
    ("RNN - differencing", "GRU", 8, 31.416, 41.037, 6.64),
    ("RNN - differencing", "BiLSTM", 9, 28.339, 34.931, 6.12),
]
