"""ledgerline: sales and user batch analytics on the PySpark DataFrame API.

Every public function is DataFrame -> DataFrame (or a sink / gate that ends
in one action). Nothing here collects row data to the driver.
"""

__version__ = "0.1.0"
