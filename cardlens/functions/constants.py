"""Fixed values that must equal the reference's for right results.

FIXED VALUES — stated plainly, in natural order, kept together.
"""

# FIXED VALUES: merchant category codes whose spending is not "good" spending.
BAD_MCC_CODES = [7801, 7802, 7994, 7995, 7800, 6300, 5960, 6010, 6011, 6012, 6211, 6529, 6530, 5933, 4829,
                 6532, 6533, 6534, 6536, 6537, 6538, 6540, 6050, 6051, 4900, 4812, 4814, 9222, 7276, 9311]

# FIXED VALUES: public holidays (ISO dates) used for the holiday flag.
HOLIDAYS = ['2016-10-04', '2016-10-05', '2016-10-06', '2016-12-31',
            '2017-01-01', '2017-01-02', '2017-01-03', '2017-01-04', '2017-01-05', '2017-01-06', '2017-01-07',
            '2017-01-08',
            '2017-02-23', '2017-02-24', '2017-02-25', '2017-02-26',
            '2017-03-08',
            '2017-04-29', '2017-04-30', '2017-05-01',
            '2017-05-06', '2017-05-07', '2017-05-08', '2017-05-09',
            '2017-06-10', '2017-06-11', '2017-06-12',
            '2017-11-03', '2017-11-06', '2017-11-07', '2017-11-08',
            '2017-12-30', '2017-12-31',
            '2018-01-01', '2018-01-02', '2018-01-03', '2018-01-04', '2018-01-05', '2018-01-06', '2018-01-07',
            '2018-01-08',
            '2018-02-23', '2018-02-24', '2018-02-25',
            '2018-03-08', '2018-03-09', '2018-03-10', '2018-03-11']

# FIXED VALUES: currency codes.
USD_CODE = 840
EUR_CODE = 978
CURRENCIES = [810, 978, 840, 784]
# FIXED VALUES: flat factors that turn an exotic currency into US dollars.
TO_USD_FACTORS = {704: 0.000045, 360: 0.000074, 410: 0.000892, 170: 0.00035, 933: 0.5}
# FIXED VALUES: how many days back a missing exchange rate may be looked up (d, d-1, ..., d-9).
FX_LOOKBACK_DAYS = 9

# FIXED VALUES: tenure horizons and buckets.
MAX_DAY_NUMBER = 100
PERIOD_PARTS = [2, 4, 8, 16, 32, 64, 128]
MAX_PERIOD_DAY = 128
MAX_TRANSACTION_DAY = 93

# FIXED VALUES: categories whose amounts are income (kept positive).
IN_OPERATIONS = ['DEPOSIT', 'C2C_IN', 'BACK_TRX']
POS_CATEGORY = 'POS'

# FIXED VALUES: calendar and threshold parameters.
BASE_YEAR = 2016
DAYS_SINCE_DATE = '2015-01-01'
MONTH_STATE_THRESHOLD = 19000
RELATIVE_MONTHS = [0, -1, -2, -3, -4]
RECENCY_DAYS = [7, 14, 30, 60]
ROUND_DIVISORS = [1, 10, 100, 1000]
WEEKDAYS = [0, 1, 2, 3, 4, 5]
