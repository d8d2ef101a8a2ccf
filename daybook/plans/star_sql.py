"""The same questions as in `star.py`, as SQL over the same tables."""

ITEMS = """i as (
  select l_orderkey order_id, l_partkey product_id, cast(l_shipdate as date) order_date,
         cast(l_extendedprice as decimal(10,2)) sale_price, l_returnflag = 'R' is_returned
  from lineitem)"""

CATEGORY_VALUES = f"""{ITEMS}, po as (
  select order_id, p_brand category, order_date, sum(sale_price) order_value,
         max(case when is_returned then 1 else 0 end) returned_flag
  from i join part on product_id = p_partkey group by 1, 2, 3)"""

CATEGORY_KPI = f"""{CATEGORY_VALUES}, ck as (
  select category, order_date, cast(sum(order_value) as decimal(30,2)) daily_revenue,
         cast(sum(order_value) as double) / count(order_value) avg_order_value,
         avg(cast(returned_flag as double)) avg_return_rate
  from po group by 1, 2)"""

ORDER_KPI = """r as (
  select l_orderkey order_id, sum(cast(l_extendedprice as decimal(10,2))) order_revenue, count(*) n
  from lineitem group by 1),
m as (
  select o_orderkey order_id, o_custkey user_id, cast(o_orderdate as date) order_date,
         o_orderstatus status, order_revenue, coalesce(n, 0) num_of_item
  from orders left join r on o_orderkey = order_id),
ok as (
  select order_date, count(distinct order_id) total_orders,
         cast(sum(order_revenue) as decimal(30,2)) total_revenue,
         cast(sum(num_of_item) as bigint) total_items_sold,
         avg(case when status = 'F' then 1.0E0 else 0.0E0 end) return_rate,
         count(distinct user_id) unique_customers
  from m group by 1)"""

FILES = """files as (
  select distinct concat('validated/orders/dt=', cast(cast(o_orderdate as date) as varchar),
                         '/part-', o_orderstatus,
                         case when day(o_orderdate) = 31 then '.txt' else '.csv' end) file_key,
         cast(o_orderdate as date) dt, concat('orders_', lower(o_orderstatus)) file_type
  from orders),
pending as (
  select f.file_type, f.file_key from files f
  left join (select file_key from files where month(dt) <= 6) l on f.file_key = l.file_key
  where l.file_key is null and f.file_key like '%.csv')"""

TEXT = """t_orders as (
  select cast(o_orderkey as varchar) order_id, cast(o_custkey as varchar) user_id,
         case o_orderstatus when 'F' then strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || ' UTC'
                            when 'O' then strftime(o_orderdate, '%Y-%m-%d')
                            else strftime(o_orderdate, '%m/%d/%Y') end created_at,
         case when o_orderstatus = 'F' then 'returned' else o_orderstatus end status,
         case o_orderpriority when '1-URGENT' then ' 1 ' when '2-HIGH' then '+2'
                              when '3-MEDIUM' then '3.7' when '5-LOW' then '5.'
                              else o_orderpriority end num_of_item
  from orders),
c_orders as (
  select order_id, user_id, status,
         try_cast(nullif(regexp_extract(created_at, '^(\\d{4}-\\d{2}-\\d{2})([ T].*)?$', 1), '')
                  as date) order_date,
         try_cast(nullif(regexp_extract(num_of_item, '^\\s*[+]?(-?\\d+)(\\.\\d*)?\\s*$', 1), '')
                  as integer) num_of_item
  from t_orders),
t_items as (
  select cast(l_orderkey as varchar) order_id, cast(l_partkey as varchar) product_id,
         cast(l_shipdate as date) order_date,
         case l_linestatus when 'O' then cast(cast(l_extendedprice as decimal(12,2)) as varchar) || '5'
                           else '$' || cast(cast(l_extendedprice as decimal(12,2)) as varchar)
         end sale_price,
         l_returnflag = 'R' is_returned
  from lineitem),
c_items as (
  select order_id, product_id, order_date, try_cast(sale_price as decimal(10,2)) sale_price,
         is_returned
  from t_items)"""

FLAT_TEXT = """ft as (
  select l_orderkey || '-' || l_linenumber order_id,
         case when o_orderpriority = '4-NOT SPECIFIED' and l_quantity = 11 then ''
              else cast(o_custkey as varchar) end customer_id,
         case when o_orderpriority = '5-LOW' and l_quantity = 7
              then strftime(l_shipdate, '%d/%m/%Y') else strftime(l_shipdate, '%Y-%m-%d')
         end order_date,
         case when p_brand = 'Brand#13' and l_quantity = 3 then 'Brand' else p_brand end category,
         cast(cast(l_quantity as integer) as varchar) ||
           case when p_type = 'ECONOMY' and l_quantity = 50 then '.5' else '' end quantity,
         case when o_orderstatus = 'P' and l_quantity = 1 then '-1.00'
              else cast(cast(p_retailprice as decimal(10,2)) as varchar) end unit_price,
         case l_returnflag when 'R' then 'True' when 'A' then 'FALSE'
              else case when l_quantity = 13 then 'n/a' else 'false' end end returned,
         strftime(l_shipdate, '%Y-%m-%d') source_file
  from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey),
reasons as (
  select source_file, 'missing customer_id' reason, order_id from ft where customer_id = ''
  union all select source_file, 'bad order_date', order_id from ft
    where not regexp_matches(order_date, '^\\d{4}-\\d{2}-\\d{2}$')
  union all select source_file, 'bad quantity', order_id from ft
    where not regexp_matches(quantity, '^\\d+$') or quantity = '0'
  union all select source_file, 'bad unit_price', order_id from ft
    where cast(unit_price as decimal(12,2)) <= 0
  union all select source_file, 'bad returned', order_id from ft
    where lower(returned) not in ('true', 'false')
  union all select source_file, 'unknown category', order_id from ft
    where category not in (select p_brand from part))"""

FLAT = """f as (
  select cast(l_shipdate as date) order_date, p_brand category,
         cast(l_quantity as integer) quantity,
         cast(l_quantity as integer) * cast(p_retailprice as decimal(10,2)) revenue,
         l_returnflag = 'R' returned, l_orderkey
  from lineitem join part on l_partkey = p_partkey)"""

ARRIVALS = """rec as (
  select event_id, ts, event_type, 1 pos, 'incoming/orders/' || event_id || '.csv' key
  from events where event_type <> 'signup'
  union all
  select event_id, ts, event_type, 2,
         case when event_type = 'view' then 'static/' else 'incoming/order_items/' end
         || event_id || '.csv'
  from events where event_type not in ('signup', 'error')),
arrived as (
  select *, case when event_type = 'purchase' then 'other-bucket' else 'shop-landing' end bucket,
         case when event_type <> 'purchase' and starts_with(key, 'incoming/') then 'accepted'
              else 'skipped' end verdict
  from rec)"""

ORACLES = {
    "clean_orders": f"with {TEXT} select * from c_orders",
    "clean_items": f"with {TEXT} select * from c_items",
    "clean_reject_counts": f"""with {TEXT}
        select 'orders' file_type, 'created_at' column_name, count(*) rejected
        from c_orders where order_date is null
        union all select 'orders', 'num_of_item', count(*) from c_orders where num_of_item is null
        union all select 'order_items', 'sale_price', count(*) from c_items where sale_price is null""",
    "items_with_category": f"""with {ITEMS}
        select order_id, product_id, p_brand category, order_date, sale_price, is_returned
        from i join part on product_id = p_partkey""",
    "category_order_values": f"""with {CATEGORY_VALUES}
        select order_id, category, order_date, cast(order_value as decimal(20,2)) order_value,
               returned_flag from po""",
    "category_daily_kpi": f"with {CATEGORY_KPI} select * from ck",
    "order_revenue": """select l_orderkey order_id,
        cast(sum(cast(l_extendedprice as decimal(10,2))) as decimal(20,2)) order_revenue
        from lineitem group by 1""",
    "orders_with_revenue": f"""with {ORDER_KPI}
        select order_id, order_date, cast(order_revenue as decimal(20,2)) order_revenue from m""",
    "order_daily_kpi": f"with {ORDER_KPI} select * from ok",
    "kpi_reconciliation": f"""with {ITEMS}
        select count(*) items_without_product,
               cast(sum(sale_price) as decimal(30,2)) revenue_without_product
        from i where product_id % 10 = 0""",
    "new_files": f"with {FILES} select file_type, file_key from pending",
    "latest_file_per_type": f"""with {FILES}
        select file_type, max(file_key) latest_key, count(*) pending from pending group by 1""",
    "processed_keys": f"""with {FILES}
        select file_key, replace(file_key, 'validated/', 'processed/') done_key from files""",
    "batch_manifest": f"""with {FILES}
        select dt, 'orders' file_type, cast(count(*) as integer) n_files,
               string_agg(file_key, ',' order by file_key) files
        from files group by 1""",
    "kpi_upsert_category": """with i as (
          select l_orderkey order_id, p_brand category, cast(l_shipdate as date) order_date,
                 l_linestatus delivery, cast(l_extendedprice as decimal(10,2)) sale_price,
                 l_returnflag = 'R' is_returned
          from lineitem join part on l_partkey = p_partkey),
        po as (
          select delivery, order_id, category, order_date, sum(sale_price) order_value,
                 max(case when is_returned then 1 else 0 end) returned_flag
          from i group by 1, 2, 3, 4),
        ck as (
          select delivery, category, order_date,
                 cast(sum(order_value) as decimal(30,2)) daily_revenue,
                 cast(sum(order_value) as double) / count(order_value) avg_order_value,
                 avg(cast(returned_flag as double)) avg_return_rate
          from po group by 1, 2, 3)
        select category, order_date, daily_revenue, avg_order_value, avg_return_rate
        from ck a where delivery = 'F' or not exists (
          select 1 from ck b where b.delivery = 'F' and b.category = a.category
                               and b.order_date = a.order_date)""",
    "kpi_upsert_order": f"""with {ORDER_KPI},
        u as (
          select order_date, count(distinct order_id) total_orders,
                 cast(sum(order_revenue) as decimal(30,2)) total_revenue,
                 cast(sum(num_of_item) as bigint) total_items_sold,
                 avg(case when status = 'F' then 1.0E0 else 0.0E0 end) return_rate,
                 count(distinct user_id) unique_customers
          from m where order_id in (
            select o_orderkey from orders where o_orderpriority = '1-URGENT')
          group by 1)
        select * from u
        union all select * from ok where order_date not in (select order_date from u)""",
    "file_gate": """with low as (
          select count(*) n, count(distinct o_orderkey // 2000) files
          from orders where o_orderpriority = '5-LOW')
        select case o_orderpriority when '1-URGENT' then 'plain' when '2-HIGH' then 'reordered'
                    when '3-MEDIUM' then 'no_user' else 'other_case' end batch,
               case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'valid'
                    else 'missing_columns' end verdict,
               case o_orderpriority when '3-MEDIUM' then 'user_id'
                    when '4-NOT SPECIFIED' then 'order_id' else '' end missing,
               '' problems, count(*) n_rows
        from orders where o_orderpriority <> '5-LOW' group by 1, 2, 3
        union all select 'ragged', 'unreadable', '', 'too many fields', n + files from low
        union all select 'quoted_break', 'valid', '', '', n + files from low
        union all select 'bad_byte', 'unreadable', '', 'not utf-8', n + files from low
        union all select 'header_only', 'empty', '', '', 0
        union all select 'zero', 'unreadable', '', 'no lines', 0
        union all select 'hidden', 'unreadable', '', 'hidden from readers by its name', 0""",
    "written_manifest": """select distinct '2025-07-06' dt, 'orders' file_type, o_orderpriority batch,
               'validated/orders/dt=2025-07-06/' key_folder, 1 names_kept
        from orders where o_orderpriority <> '3-MEDIUM'
        union all select distinct '2025-07-06', 'order_items', l_returnflag,
               'validated/order_items/dt=2025-07-06/', 1
        from lineitem""",
    "stored_ledger": """with o as (
          select o_orderkey, case when o_orderdate < timestamp '1998-07-01' then 'first'
                                  else 'second' end batch from orders),
        f as (
          select 'orders' file_type, batch, count(*) n_rows from o group by 2
          union all
          select 'order_items', batch, count(*) from lineitem join o on l_orderkey = o_orderkey
          group by 2)
        select file_type, batch, case batch when 'first' then 'done' else 'pending' end state,
               n_rows from f""",
    "latest_only_kpi": f"""with {ORDER_KPI} select * from ok
        where order_date = (select max(cast(o_orderdate as date)) from orders)""",
    "flat_job_kpi": """with r as (
          select distinct l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_shipdate,
                 l_suppkey, l_discount, l_tax, o_custkey, l_returnflag,
                 cast(l_quantity as integer) quantity,
                 case when l_quantity = 1 then 100000000.000
                      when l_quantity = 3 then cast(p_retailprice as decimal(10,2)) + 0.005
                      else cast(p_retailprice as decimal(10,2)) end unit_price
          from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey)
        select cast(l_shipdate as date) order_date, count(*) total_orders,
               cast(sum(quantity * cast(unit_price as decimal(18,3))) as decimal(30,2)) total_revenue,
               cast(sum(quantity) as bigint) total_items_sold,
               avg(case when l_returnflag = 'R' then 1.0E0 else 0.0E0 end) return_rate,
               count(distinct o_custkey) unique_customers
        from r group by 1""",
    "quarantined_lines": f"""with {FLAT_TEXT}
        select 'missing_columns' verdict, 'user_id' reason, count(*) n
        from orders
        union all select 'rejected_rows', reason, count(*) from reasons group by 2""",
    "flat_file_gate": f"""with {FLAT_TEXT}
        select 'headed' batch, 'valid' verdict, 0 n_missing, count(*) n_rows from ft
        union all select 'bare', 'missing_columns', 8, count(*) from ft
        union all select 'header_only', 'empty', 0, 0""",
    "idle_run": """select 'orders alone' step, false ran, 0 n_days, false marked
        union all select 'both', true, count(distinct cast(o_orderdate as date)), true
        from orders where o_orderdate < timestamp '1998-07-01'""",
    "stream_order_kpi": f"with {ORDER_KPI} select * from ok",
    "landed_category_kpi": f"with {CATEGORY_KPI} select * from ck",
    "run_summary": f"""with {CATEGORY_KPI}, {ORDER_KPI}, {FILES}
        select 'category_kpis' output, count(*) n_rows from ck
        union all select 'order_kpis', count(*) from ok
        union all select 'pending_files', count(*) from pending""",
    "arrival_events": f"""with {ARRIVALS}
        select event_id, bucket, key, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') "timestamp"
        from arrived where verdict = 'accepted'""",
    "arrival_summary": f"""with {ARRIVALS}
        select verdict, count(*) n from arrived group by 1
        union all select 'malformed', count(*) from events where event_type in ('signup', 'error')""",
    "arrival_status": """select event_id,
          case event_type when 'signup' then 400 when 'error' then 500 else 200 end status_code,
          case event_type when 'signup' then 0 when 'error' then 1 else 2 end n
        from events""",
    "row_quality": f"""with {FLAT_TEXT}
        select reason, count(*) n from reasons group by 1
        union all select 'good', count(*) from ft
          where customer_id <> '' and regexp_matches(order_date, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$')
            and regexp_matches(quantity, '^[1-9]\\d*$')
            and cast(unit_price as decimal(12,2)) > 0
            and lower(returned) in ('true', 'false')
            and category in (select p_brand from part)""",
    "duplicate_orders": """select l_orderkey, l_linenumber, count(*) n
        from lineitem group by 1, 2 having count(*) > 1""",
    "rejected_files": f"""with {FLAT_TEXT},
        d as (select source_file, order_id, count(*) n from ft group by 1, 2 having count(*) > 1)
        select source_file, reason, count(*) n from reasons group by 1, 2
        union all select source_file, 'duplicate order_id', cast(sum(n) as bigint) from d group by 1""",
    "flat_category_kpi": f"""with {FLAT}
        select category, order_date, cast(sum(revenue) as decimal(30,2)) daily_revenue,
               cast(sum(revenue) as double) / count(*) avg_order_value,
               avg(case when returned then 1.0E0 else 0.0E0 end) avg_return_rate
        from f group by 1, 2""",
    "flat_daily_kpi": f"""with {FLAT}
        select order_date, count(*) total_orders,
               cast(sum(revenue) as decimal(30,2)) total_revenue,
               cast(sum(quantity) as bigint) total_items_sold,
               avg(case when returned then 1.0E0 else 0.0E0 end) return_rate,
               count(distinct o_custkey) unique_customers
        from f join orders on l_orderkey = o_orderkey group by 1""",
    "kpi_category_range": f"""with {CATEGORY_KPI} select * from ck
        where category = 'Brand#7' and order_date between date '1997-01-01' and date '1997-12-31'""",
    "kpi_category_day": f"""with {CATEGORY_KPI} select * from ck
        where category = 'Brand#7' and order_date = date '1997-06-24'""",
    "kpi_day_range": f"""with {ORDER_KPI} select * from ok
        where order_date between date '1997-01-01' and date '1997-03-31'""",
    "revenue_by_category": f"""with {CATEGORY_KPI}
        select category, cast(sum(daily_revenue) as decimal(38,2)) revenue from ck group by 1""",
    "kpi_trend": f"with {ORDER_KPI} select order_date, total_revenue, return_rate from ok",
    "headline_totals": f"""with {ORDER_KPI}
        select cast(sum(total_orders) as bigint) total_orders,
               (select count(distinct o_custkey) from orders) unique_customers from ok""",
}
