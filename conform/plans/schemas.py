"""Declared schemas of the raw feeds."""

from __future__ import annotations

# Names, order and types of the columns in each feed (one name is spelled as it arrives).
RAW_SCHEMAS = {
    "crm_cust_info": """
        cst_id int,
        cst_key string,
        cst_firstname string,
        cst_lastname string,
        cst_martial_status string,
        cst_gndr string,
        cst_create_date date""",
    "crm_prd_info": """
        prd_id int,
        prd_key string,
        prd_nm string,
        prd_cost int,
        prd_line string,
        prd_start_dt timestamp,
        prd_end_dt timestamp""",
    "crm_sales_details": """
        sls_ord_num string,
        sls_prd_key string,
        sls_cust_id int,
        sls_order_dt int,
        sls_ship_dt int,
        sls_due_dt int,
        sls_sales int,
        sls_quantity int,
        sls_price int""",
    "erp_loc_a101": """
        cid string,
        cntry string""",
    "erp_cust_az12": """
        cid string,
        bdate date,
        gen string""",
    "erp_px_cat_g1v2": """
        id string,
        cat string,
        subcat string,
        maintenance string""",
}

# The file of each feed, by source system.
FEED_FILES = {
    "crm": {
        "crm_cust_info": "cust_info.csv",
        "crm_prd_info": "prd_info.csv",
        "crm_sales_details": "sales_details.csv",
    },
    "erp": {
        "erp_cust_az12": "CUST_AZ12.csv",
        "erp_loc_a101": "LOC_A101.csv",
        "erp_px_cat_g1v2": "PX_CAT_G1V2.csv",
    },
}
