"""Fixed values of the expected results: limits, labels, rules and lists, stated apart from the code they check."""

from __future__ import annotations

SALES_LIMITS = [500, 1000, 2000, 3000, 5000, 8000]

SALES_LABELS = ['A. Under 500', 'B. 500 - 1K', 'C. 1K - 2K', 'D. 2K - 3K', 'E. 3K - 5K', 'F. 5K - 8K', 'G. 8K+']

SALES_LABELS_COMPACT = ['A. Under 500', 'B. 500-1K', 'C. 1K-2K', 'D. 2K-3K', 'E. 3K-5K', 'F. 5K-8K', 'G. 8K+']

RATING_LIMITS = ['2.0', '3.0', '3.5', '4.0', '4.5']

RATING_LABELS = ['1.0 - 1.9  Critical',
 '2.0 - 2.9  Poor',
 '3.0 - 3.4  Below par',
 '3.5 - 3.9  Acceptable',
 '4.0 - 4.4  Good',
 '4.5 - 5.0  Excellent']

RATING_LABELS_COMPACT = ['1.0-1.9 Critical', '2.0-2.9 Poor', '3.0-3.4 Below par', '3.5-3.9 Acceptable', '4.0-4.4 Good', '4.5-5.0 Excellent']

RATING_LIMITS_5 = ['3.0', '3.5', '4.0', '4.5']

RATING_LABELS_5 = ['Under 3.0', '3.0 - 3.4', '3.5 - 3.9', '4.0 - 4.4', '4.5 - 5.0']

RATING_LABELS_5_COMPACT = ['Under 3.0', '3.0-3.4', '3.5-3.9', '4.0-4.4', '4.5-5.0']

SEGMENTS = {(True, True): ('1. Star (high revenue, high rating)', 'Protect stock. Never allow a stock-out.'),
 (True, False): ('2. Fix quality (high revenue, low rating)',
                 'Supplier review. Volume is amplifying a quality problem.'),
 (False, True): ('3. Promote (low revenue, high rating)', 'Raise visibility. Customers like it but cannot find it.'),
 (False, False): ('4. Delist candidate (low revenue, low rating)', 'Free the shelf space for an A-item.')}

SHORT = {(False, False): 'Delist candidate', (False, True): 'Promote', (True, False): 'Fix quality', (True, True): 'Star'}

ABC_LABELS = ['A (top 80% of revenue)', 'B (next 15%)', 'C (final 5%)']

FORMAT_COLUMNS = {'Grocery Store': 'grocery_store',
 'Supermarket Type1': 'supermarket_t1',
 'Supermarket Type2': 'supermarket_t2',
 'Supermarket Type3': 'supermarket_t3'}

QUINTILE_LABELS = ['1 - Lowest visibility', '2', '3 - Middle', '4', '5 - Highest visibility']

SUMMARY_LINES = {'Total Revenue (INR)': 'Headline topline',
 'Sales Records': 'Volume of product-outlet sales',
 'Average Sale (INR)': 'Basket value - the growth-quality lever',
 'Average Rating': 'Customer satisfaction guardrail',
 'Products / Categories': 'Assortment breadth',
 'Outlets': 'Network footprint',
 'Top Category': 'Largest revenue pool - protect first',
 'Top Outlet': 'Benchmark store - copy its playbook',
 'Best Format by Revenue/Store': 'Where the next store should be opened',
 'Peak Month': 'Build inventory ahead of this month'}

CARDS = {'TOTAL REVENUE': 'INR, all outlets',
 'AVG SALE VALUE': 'Basket value',
 'AVG RATING': 'Customer satisfaction',
 'SALES RECORDS': 'Product x outlet rows',
 'PRODUCTS': 'Distinct SKUs',
 'CATEGORIES': 'Item types'}

EXAMPLE_CHOICE = {'item_type': ['LARGE', 'PROMO'],
 'outlet_size': ['Small', 'Unknown'],
 'order_year': [1999, 2000],
 'item_fat_content': ['Low Fat']}
SINGLE_CHOICE = {'outlet_location_type': ['Tier 2']}
EMPTY_CHOICE = {'order_year': [1899], 'outlet_type': ['Grocery Store']}

SEGMENT_TABLES = {'outlet_type': 'outlet_type',
 'tier': 'outlet_location_type',
 'outlet_size': 'outlet_size',
 'fat_content': 'item_fat_content'}

DECISIONS = [('spellings',
  'spellings of fat content',
  'Map to Low Fat / Regular; trim all text',
  'Groups would split across spellings.'),
 ('missing_weight',
  'missing item weights',
  "Fill with the item's median, else the category's",
  'Keeps the rows and their revenue; weight belongs to the product.'),
 (None, 'Missing outlet size', 'Label Unknown', 'Whole outlets lack it, so there is nothing to fill from.'),
 ('zero_visibility',
  'zero visibilities',
  "Treat as missing, fill with the category's median, keep a flag",
  'A product that sells takes shelf space.'),
 ('copies', 'duplicate rows', 'Keep one of each', 'Each copy counts revenue again.'),
 (None, 'Ratings with too many decimals', 'Round to one decimal', 'Ratings are given on that scale.'),
 (None, 'Right-skewed sales', 'Keep, flag and report the median as well', 'Large sales are real.'),
 (None, 'Numbers and dates as text', 'Declare types', 'Sums and date ranges need them.')]

GAP_NOTES = {'item_weight': 'Not captured when the product was listed.', 'outlet_size': 'Never reported by some outlets.'}

LISTED_COLUMNS = ['item_type', 'outlet_size', 'outlet_location_type', 'outlet_type', 'outlet_identifier']

ALLOWED_VALUES = {'item_fat_content': ['Low Fat', 'Regular'],
 'outlet_size': ['Small', 'Medium', 'High', 'Unknown'],
 'outlet_location_type': ['Tier 1', 'Tier 2', 'Tier 3'],
 'outlet_type': ['Grocery Store', 'Supermarket Type1', 'Supermarket Type2', 'Supermarket Type3']}

CHECKS = {'sales_positive': 'sales > 0',
 'rating_range': 'rating BETWEEN 1 AND 5',
 'visibility_range': 'item_visibility BETWEEN 0 AND 1',
 'weight_positive': 'item_weight > 0',
 'month_range': 'order_month BETWEEN 1 AND 12'}

COLUMN_ROLES = {'item_identifier': ('text', 'VARCHAR(10)', 'Product key (dimension)'),
 'item_weight': ('text w/ blanks', 'DECIMAL(6,3)', 'Product attribute'),
 'item_fat_content': ('text', 'VARCHAR(10)', 'Category (needs cleaning)'),
 'item_visibility': ('text', 'DECIMAL(9,6)', 'Shelf-share metric'),
 'item_type': ('text', 'VARCHAR(40)', 'Category (dimension)'),
 'outlet_identifier': ('text', 'CHAR(6)', 'Store key (dimension)'),
 'outlet_establishment_year': ('text', 'SMALLINT', 'Store attribute'),
 'outlet_size': ('text w/ blanks', 'VARCHAR(10)', 'Category (dimension)'),
 'outlet_location_type': ('text', 'VARCHAR(10)', 'Category (dimension)'),
 'outlet_type': ('text', 'VARCHAR(25)', 'Category (dimension)'),
 'sales': ('text', 'DECIMAL(10,4)', 'Primary measure (INR)'),
 'rating': ('text', 'DECIMAL(3,2)', 'Measure (1-5 scale)'),
 'order_date': ('text', 'DATE', 'Time dimension')}

RAW_COLUMNS = ['item_identifier',
 'item_weight',
 'item_fat_content',
 'item_visibility',
 'item_type',
 'outlet_identifier',
 'outlet_establishment_year',
 'outlet_size',
 'outlet_location_type',
 'outlet_type',
 'sales',
 'rating',
 'order_date']

REPORT_COLUMNS = ['item_identifier',
 'item_type',
 'item_fat_content',
 'item_weight',
 'item_visibility',
 'outlet_identifier',
 'outlet_establishment_year',
 'outlet_size',
 'outlet_location_type',
 'outlet_type',
 'sales',
 'rating',
 'order_date',
 'order_year',
 'order_month',
 'order_month_name',
 'order_year_month',
 'order_quarter']

REQUIRED_COLUMNS = ['sale_id',
 'item_identifier',
 'item_type',
 'item_fat_content',
 'item_weight_imputed',
 'item_visibility',
 'item_visibility_imputed',
 'outlet_identifier',
 'outlet_establishment_year',
 'outlet_age_years',
 'outlet_size',
 'outlet_location_type',
 'outlet_type',
 'sales',
 'rating',
 'order_date',
 'order_year',
 'order_month',
 'order_month_name',
 'order_quarter',
 'order_year_month',
 'order_weekday',
 'is_weekend']

SPOILED = {'sales': (97, 5, 'n/a'),
 'order_date': (89, 3, '2021-13-40'),
 'item_weight': (83, 7, '12,5'),
 'rating': (79, 11, '99999.5'),
 'item_fat_content': (73, 2, 'xx')}

COERCED_TYPES = {'item_weight': 'DECIMAL(6,3)',
 'item_visibility': 'DECIMAL(9,6)',
 'outlet_establishment_year': 'INTEGER',
 'sales': 'DECIMAL(10,4)',
 'rating': 'DECIMAL(4,3)'}
