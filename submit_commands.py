"""spark-submit entry: ``submit_commands.py warehouse --staged ...`` or ``... sql --out ...``"""

import sys

from payerlens.plans.commands import analyst_sql, warehouse

if __name__ == "__main__":
    {"warehouse": warehouse, "sql": analyst_sql}[sys.argv[1]](sys.argv[2:])
