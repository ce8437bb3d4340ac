"""The queries again, as plain SQL over the given tables, for comparison by DuckDB.

Written independently of the Spark side: windows over all shifts of a person, range joins
and a trial of every offset take the place of blocks, spans and running windows.
"""

from __future__ import annotations

BASE = """
with staff as (
  select s_suppkey as staff_id, s_name as staff_name,
    case when s_suppkey % 9 < 5 then 'Female' else 'Male' end as gender,
    (['Nurse','Doctor','Admin','Surgeon','Radiologist','Pharmacist','Physiotherapist',
      'Technician'])[s_suppkey % 8 + 1] as role,
    (['Junior','Senior','Experienced'])[s_suppkey % 3 + 1] as experience_level,
    (['ICU','ER','General Ward','Pediatrics','Oncology','Cardiology','Radiology',
      'Pathology'])[s_nationkey % 8 + 1] as department,
    date '2015-01-01' + cast(s_suppkey * 37 % 3650 as integer) as hire_date,
    (['permanent','temporary','hourly'])[s_suppkey % 3 + 1] || '/'
      || case when s_suppkey % 9 < 5 then 'Female' else 'Male' end as employment_type,
    (['early','late','none'])[s_suppkey % 3 + 1] as shift_preference,
    case when s_suppkey % 20 = 19 then 'Inactive' when s_suppkey % 20 = 9 then 'On Leave'
      else 'Active' end as status,
    'site ' || s_nationkey as base_location,
    cast((([350,800,250,1200,900,600,400,300])[s_suppkey % 8 + 1])
      * (([1.0,1.4,1.8])[s_suppkey % 3 + 1]) as decimal(10,2))
      + cast(s_suppkey * 37 % 100 as decimal(10,2)) * 0.01 as rate
  from supplier
), staff_master as (
  select * exclude (rate), cast(rate as double) as per_hour_rate,
    case when rate * 2080 < 400000 then 'Band A' when rate * 2080 < 700000 then 'Band B'
      when rate * 2080 < 1100000 then 'Band C' when rate * 2080 < 1600000 then 'Band D'
      else 'Band E' end as salary_band,
    cast(0 as bigint) as night_shift_female_flag
  from staff
), lines as (
  select * exclude (rn) from (
    select *, row_number() over (partition by l_orderkey, l_linenumber order by
      l_shipdate desc, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax,
      l_returnflag, l_linestatus) as rn from lineitem)
  where rn = 1
), all_shifts as (
  select l_orderkey * 10 + l_linenumber as timesheet_id, l_suppkey as staff_id,
    cast(l_shipdate as date) as shift_date,
    case when l_linestatus = 'F' then 'Night' else 'Day' end as shift_type,
    8 + cast(l_quantity as bigint) % 7 as shift_duration_hours,
    20 + l_partkey % 41 as break_minutes, l_partkey % 20 <> 0 as logged_hours_flag,
    cast(case when l_partkey % 20 < 3 then 1 else 0 end as bigint) as cross_post_flag,
    (['ICU','ER','General Ward','Pediatrics','Oncology','Cardiology','Radiology',
      'Pathology'])[l_partkey % 8 + 1] as other_department,
    1 + case when l_partkey % 10 < 6 then l_partkey % 3 else 2 + l_partkey % 14 end
      as assignment_count,
    l_partkey as case_seed
  from lines
), years as (select distinct cast(year(l_shipdate) as integer) as y from lineitem
), surge as (
  select make_date(y, m1, d1) as first_day, make_date(y, m2, d2) as last_day
  from years, (values (1,15,1,25),(3,1,3,10),(5,5,5,15),(7,20,7,30),(9,10,9,20))
    as t(m1, d1, m2, d2)
), surge_days as (
  select cast(unnest(generate_series(first_day, last_day, interval 1 day)) as date) as surge_day
  from surge
), shifts as (
  select h.*, s.gender, s.role, s.experience_level, s.department as home_department, s.status,
    s.rate,
    cast(h.shift_date as timestamp) + to_hours(case when shift_type = 'Day' then 7 else 19 end)
      as shift_start,
    cast(h.shift_date as timestamp) + to_hours(case when shift_type = 'Day' then 7 else 19 end)
      + to_hours(cast(shift_duration_hours as integer)) as shift_end,
    greatest(0, shift_duration_hours - 8) as overtime,
    cast(case when h.shift_date in (select surge_day from surge_days) then 1 else 0 end
      as bigint) as surge_period_flag,
    cast(case when shift_type = 'Night' then 1 else 0 end as bigint) as night_flag,
    cast(case when shift_type = 'Night' and s.gender = 'Female' then 1 else 0 end as bigint)
      as female_night_flag,
    case when cross_post_flag = 1 then other_department else s.department end
      as department_override
  from all_shifts h join staff s on h.staff_id = s.staff_id and s.status = 'Active'
), paid as (
  select *, case when overtime = 0 then 0.0 when overtime <= 2 then 1.5
      when overtime <= 4 then 2.0 else 2.5 end as multiplier
  from shifts
), assignments as (
  select timesheet_id * 100 + i as assignment_id, timesheet_id, staff_id,
    printf('PAT_%06d', 100000 + (timesheet_id * 100 + i) % 899999) as patient_id,
    shift_date as assignment_date, 1 + (case_seed + i) % 5 as severity_level,
    department_override as department,
    case when (case_seed * 13 + i) % 5 < 2 then 'Emergency' else
      (['Routine','Surgery','Consultation','Follow-up'])[(case_seed + i) % 4 + 1] end
      as case_type,
    15 + (case_seed + i * 7) % 166 as assignment_duration_minutes,
    cast(case when (case_seed * 7 + i * 3) % 10 < 4 then 1 else 0 end as bigint)
      as critical_flag,
    cast(case when surge_period_flag = 1 and (case_seed * 13 + i) % 5 < 2 then 1 else 0 end
      as bigint) as surge_emergency_flag
  from (select *, unnest(range(1, assignment_count + 1)) as i from shifts)
), cases as (
  select staff_id, assignment_date as shift_date,
    count(*) filter (where critical_flag = 1) as critical_cases,
    count(*) filter (where case_type = 'Emergency') as emergency_cases
  from assignments group by all
), days as (select distinct staff_id, shift_date from shifts
), islands as (
  select *, shift_date - cast(row_number() over (partition by staff_id order by shift_date)
    as integer) as island from days
), streaks as (
  select *, count(*) over (partition by staff_id, island) as streak_length from islands
), history as (
  select p.*, coalesce(critical_cases, 0) as critical_cases,
    coalesce(emergency_cases, 0) as emergency_cases,
    cast(case when k.streak_length > 4 then 1 else 0 end as bigint) as consecutive_days_flag,
    lag(shift_end) over by_start as prev_end,
    lag(shift_duration_hours) over by_start as prev_hours,
    lag(shift_type) over by_date as prev_type
  from paid p left join cases using (staff_id, shift_date)
    left join streaks k using (staff_id, shift_date)
  window by_start as (partition by staff_id order by shift_start, shift_end, timesheet_id),
    by_date as (partition by staff_id order by shift_date, timesheet_id)
), flagged as (
  select *, date_diff('second', prev_end, shift_start) / 3600.0 as gap,
    cast(case when prev_type = 'Night' and shift_type = 'Day' then 1 else 0 end as bigint)
      as night_to_day_flip_flag
  from history
), scored as (
  select *,
    cast(case when shift_duration_hours >= 12 and prev_hours >= 12 and gap >= 0 and gap <= 24
      then 1 else 0 end as bigint) as back_to_back_12h_flag,
    cast(least(100, greatest(0, 2 * overtime + 3 * critical_cases + 5 * night_flag
      + 4 * consecutive_days_flag + 3 * emergency_cases)) as bigint) as acute_score,
    0.4 * (case role when 'Nurse' then 1.0 when 'Doctor' then 0.8 when 'Surgeon' then 1.1
        when 'Radiologist' then 0.7 when 'Pharmacist' then 0.6 when 'Physiotherapist' then 0.6
        when 'Technician' then 0.7 when 'Admin' then 0.4 else 0.6 end)
      + 0.4 * (case home_department when 'ICU' then 1.1 when 'ER' then 1.1
        when 'Oncology' then 0.9 when 'Cardiology' then 0.8 when 'General Ward' then 0.6
        when 'Pediatrics' then 0.6 when 'Radiology' then 0.4 when 'Pathology' then 0.4
        else 0.5 end)
      + 0.2 * (case experience_level when 'Junior' then 0.9 when 'Senior' then 0.7
        when 'Experienced' then 0.6 else 0.7 end) as susceptible,
    cast(0.20 * overtime + 0.70 * night_flag + 0.80 * surge_period_flag
      + 0.90 * consecutive_days_flag as decimal(10,2)) as load
  from flagged
), probable as (
  select *, least(greatest(0.01 + 0.06 * susceptible + 0.03 * load, 0), 0.45) as p,
    cast('0x' || substr(md5('42:' || timesheet_id), 1, 8) as bigint) as u1,
    cast('0x' || substr(md5('43:' || timesheet_id), 1, 8) as bigint) as u2
  from scored
), lifted as (
  select *, cast(case when u1 % 1000000 < p * 1000000 then 8 + u2 % 15 else 0 end as bigint)
      as chronic_boost
  from probable
), final as (
  select *, least(100, acute_score + chronic_boost) as burnout_score from lifted
), timesheet as (
  select timesheet_id, staff_id, shift_date, shift_start, shift_end, shift_type,
    shift_duration_hours, cast(overtime as double) as overtime_hours, break_minutes,
    department_override, logged_hours_flag, burnout_score,
    case when burnout_score <= 30 then 'Low' when burnout_score <= 55 then 'Medium'
      when burnout_score <= 75 then 'High' else 'Critical' end as burnout_risk_label,
    surge_period_flag, consecutive_days_flag, back_to_back_12h_flag, night_to_day_flip_flag,
    female_night_flag, cast(multiplier as double) as overtime_multiplier,
    cast(round_even(cast(overtime as decimal(10,2)) * cast(rate as decimal(10,2))
      * cast(multiplier as decimal(3,1)), 2) as double) as overtime_pay
  from final
), raw_assignments as (
  select l_orderkey * 10 + l_linenumber as timesheet_id, l_suppkey as staff_id,
    cast(l_shipdate as date) as assignment_date,
    (['ICU','ER','General Ward','Pediatrics','Oncology','Cardiology','Radiology',
      'Pathology'])[l_partkey % 8 + 1] as department
  from (select *, unnest(range(1, 2 + case when l_partkey % 10 < 6 then l_partkey % 3
    else 2 + l_partkey % 14 end)) as i from lineitem)
), raw_requests as (
  select o_orderkey as leave_id, o_custkey % (select count(*) from supplier) as staff_id,
    cast(o_orderdate as date) as leave_start, 1 + o_orderkey % 14 as duration_days,
    (['Sick','Vacation','Personal','Maternity/Paternity','Study',
      'Bereavement'])[o_custkey % 6 + 1] as leave_type,
    case o_orderstatus when 'F' then 'Approved' when 'O' then 'Pending'
      when 'P' then 'Rejected' end as approval_status,
    o_orderpriority = '1-URGENT' as emergency_leave_flag
  from orders
), requests as (
  select * from raw_requests
  where staff_id in (select staff_id from staff where status is distinct from 'Inactive')
), asked as (
  select *, least(leave_start + cast(duration_days as integer), date '2001-08-01') as leave_end
  from requests
), worked as (
  select distinct staff_id, shift_date from shifts
  where staff_id in (select staff_id from requests)
), worked_in_window as (select * from worked where shift_date <= date '2001-08-01'
), tries as (
  select leave_id, staff_id, k, least(leave_start + k, date '2001-08-01') as s,
    least(least(leave_start + k, date '2001-08-01') + cast(duration_days as integer),
      date '2001-08-01') as e
  from requests, (select cast(unnest(range(0, 120)) as integer) as k)
), free as (
  select leave_id, min(k) as k from tries t
  where not exists (select 1 from worked_in_window w
    where w.staff_id = t.staff_id and w.shift_date between t.s and t.e)
  group by leave_id
), placed as (
  select r.* exclude (leave_start), cast(coalesce(f.k, 120) as integer) as k,
    least(r.leave_start + cast(coalesce(f.k, 120) as integer), date '2001-08-01') as leave_start
  from requests r left join free f using (leave_id)
), moved as (
  select *, least(leave_start + cast(duration_days as integer), date '2001-08-01') as leave_end
  from placed
), leaves as (
  select leave_id, staff_id, leave_start, leave_end, leave_type,
    cast(leave_end - leave_start as bigint) as leave_days_count, approval_status,
    emergency_leave_flag
  from moved
), weeks as (
  select *, strftime(shift_date, '%G-W%V') as year_week,
    case burnout_risk_label when 'Low' then 0 when 'Medium' then 1 when 'High' then 2
      when 'Critical' then 3 end as risk
  from timesheet
), weekly as (
  select staff_id, year_week,
    cast(sum(cast(overtime_hours as decimal(12,2))) as double) as total_overtime_hours,
    round_even(avg(burnout_score), 2) as avg_burnout_score,
    max(burnout_score) as max_burnout_score,
    count(*) filter (where shift_type = 'Night') as night_shifts_count,
    cast(sum(surge_period_flag) as bigint) as surge_shifts_count,
    count(*) filter (where burnout_score >= 76) as high_burnout_days,
    max(consecutive_days_flag) as consecutive_days_flag,
    cast(sum(back_to_back_12h_flag) as bigint) as back_to_back_12h_count,
    cast(sum(night_to_day_flip_flag) as bigint) as night_to_day_flips,
    cast(sum(female_night_flag) as bigint) as female_night_shifts,
    cast(sum(shift_duration_hours) as bigint) as total_shift_hours,
    count(timesheet_id) as shift_count,
    (['Low','Medium','High','Critical'])[max(risk) + 1] as worst_burnout_risk
  from weeks group by staff_id, year_week
)
"""

# every table of the given folder
TABLES = (
    "benchmark conversations customer documents embeddings events labels lineitem nation orders "
    "pages part region supplier"
).split()

ORACLE = {
    # sources and sinks
    "bronze_read": "select * from lineitem",
    "parquet_write": """select h.* from all_shifts h
        join staff s on h.staff_id = s.staff_id and s.status = 'Active'""",
    "bronze_land": " union all ".join(
        f"select '{name}' as table_name, count(*) as row_count from {name}" for name in TABLES
    ),
    "silver_write": "select * from orders",
    "silver_staff_master": """select * replace (printf('STF_%07d', staff_id) as staff_id)
        from staff_master""",
    "silver_staff_timesheet": """select * replace (printf('TS_%08d', timesheet_id)
        as timesheet_id, printf('STF_%07d', staff_id) as staff_id) from timesheet""",
    "silver_patient_assignment": """select * exclude (timesheet_id) replace
        (printf('ASN_%08d', assignment_id) as assignment_id,
        printf('STF_%07d', staff_id) as staff_id) from assignments""",
    "silver_leave_records": """select * replace (printf('LV_%08d', leave_id) as leave_id,
        printf('STF_%07d', staff_id) as staff_id) from leaves""",
    # cleaning
    "dedup_by_key": "select * from lines",
    "silver_stamp": "select *, true as stamped_by_this_run from lines",
    "dedup_staff_attrs": """select staff_id, role, salary_band, gender, department
        from staff_master""",
    "distinct_staff_days": "select * from days",
    # staff
    "staff_hourly_rate": """select staff_id, role, experience_level,
        cast(round_even((([350,800,250,1200,900,600,400,300])[staff_id % 8 + 1])
          * (([1.0,1.4,1.8])[staff_id % 3 + 1])
          * cast(cast(900000 + staff_id * 7919 % 200001 as decimal(10,0)) * 0.000001
            as decimal(18,12)), 2) as double) as per_hour_rate
        from staff""",
    "salary_band": "select staff_id, per_hour_rate, salary_band from staff_master",
    "employment_type_split": """select staff_id, employment_type,
        (['permanent','temporary','hourly'])[staff_id % 3 + 1] as employment_base,
        gender as employment_gender from staff""",
    "surrogate_key": """select printf('TS_%08d', row_number() over (order by timesheet_id))
        as timesheet_key, timesheet_id, staff_id, shift_date from shifts""",
    "staff_female_night_backfill": """select staff_id, gender,
        cast(case when staff_id in (select staff_id from shifts where female_night_flag = 1)
          then 1 else 0 end as bigint) as night_shift_female_flag from staff""",
    "active_staff": "select staff_id, status, role, department from staff where status = 'Active'",
    "leave_eligible_staff": """select staff_id, status, role, department from staff
        where status <> 'Inactive' or status is null""",
    "shift_staff_lookup": """select h.timesheet_id, h.staff_id, h.shift_date,
        coalesce(s.gender, '') as gender, s.department as home_department,
        s.status as staff_status, s.per_hour_rate, s.role, s.experience_level
        from all_shifts h left join staff_master s on h.staff_id = s.staff_id""",
    # shifts
    "surge_windows": """select first_day as surge_start, last_day as surge_end from surge
        where year(first_day) in (select year(l_shipdate) from lineitem)""",
    "surge_flag": "select timesheet_id, staff_id, shift_date, surge_period_flag from shifts",
    "shift_interval": """select timesheet_id, shift_date, shift_type, shift_duration_hours,
        shift_start, shift_end from shifts""",
    "qa_shift_duration_rule": """select surge_period_flag, count(*) as shift_count,
        count(*) filter (where shift_duration_hours > 12 or shift_duration_hours <
          case when surge_period_flag = 1 then 10 else 8 end) as violations
        from shifts group by surge_period_flag""",
    "overtime_hours": """select timesheet_id, shift_duration_hours,
        cast(overtime as double) as overtime_hours from shifts""",
    "night_flag": "select timesheet_id, shift_type, night_flag from shifts",
    "female_night_flag": "select timesheet_id, gender, shift_type, female_night_flag from shifts",
    "department_override": """select timesheet_id, home_department, cross_post_flag,
        department_override from shifts""",
    "overtime_multiplier": """select timesheet_id, cast(overtime as double) as overtime_hours,
        cast(multiplier as double) as overtime_multiplier from paid""",
    "overtime_pay": """select timesheet_id, staff_id, cast(overtime as double) as overtime_hours,
        cast(rate as double) as per_hour_rate, cast(multiplier as double) as overtime_multiplier,
        cast(round_even(cast(overtime as decimal(10,2)) * cast(rate as decimal(10,2))
          * cast(multiplier as decimal(3,1)), 2) as double) as overtime_pay from paid""",
    "consecutive_days": """select timesheet_id, staff_id, shift_date, consecutive_days_flag
        from flagged""",
    "staff_streaks": """select staff_id, min(shift_date) as streak_start,
        max(shift_date) as streak_end, count(*) as streak_length
        from islands group by staff_id, island""",
    "back_to_back_12h": """select timesheet_id, staff_id, shift_date, back_to_back_12h_flag
        from scored""",
    "shift_gap_hours": """select timesheet_id, staff_id, shift_date,
        cast(gap as double) as gap_hours from flagged""",
    "night_to_day_flip": """select timesheet_id, staff_id, shift_date, shift_type,
        night_to_day_flip_flag from flagged""",
    "timesheet_enriched": "select * from timesheet",
    # assignments
    "assignment_expand": """select timesheet_id, staff_id, shift_date as assignment_date,
        department_override as department,
        cast(unnest(range(1, assignment_count + 1)) as integer) as assignment_no from shifts""",
    "surge_emergency_flag": """select assignment_id, assignment_date, case_type,
        surge_emergency_flag from assignments""",
    "critical_cases": """select staff_id, shift_date, critical_cases from cases
        where critical_cases > 0""",
    "emergency_cases": """select staff_id, shift_date, emergency_cases from cases
        where emergency_cases > 0""",
    "shift_case_counts": """select timesheet_id, staff_id, shift_date, critical_cases,
        emergency_cases from history""",
    "case_mix": """select department, case_type, case_count,
        round_even(case_count / sum(case_count) over (partition by department), 4) as share,
        cast((case department when 'ICU' then [0.45,0.20,0.20,0.10,0.05]
          when 'ER' then [0.55,0.20,0.10,0.10,0.05]
          when 'General Ward' then [0.10,0.55,0.10,0.15,0.10]
          when 'Pediatrics' then [0.18,0.45,0.07,0.20,0.10]
          when 'Oncology' then [0.12,0.35,0.10,0.18,0.25]
          when 'Cardiology' then [0.25,0.35,0.18,0.12,0.10]
          when 'Radiology' then [0.05,0.30,0.10,0.40,0.15]
          when 'Pathology' then [0.03,0.32,0.05,0.45,0.15]
          else [0.20,0.40,0.12,0.18,0.10] end)[list_position(
          ['Emergency','Routine','Surgery','Consultation','Follow-up'], case_type)] as double)
          as expected_share
        from (select department, case_type, count(*) as case_count from assignments group by all)""",
    "assignments_per_shift": """select assignment_count, shift_count,
        round_even(shift_count / sum(shift_count) over (), 4) as share,
        cast(case assignment_count when 1 then 0.65 when 2 then 0.25 when 3 then 0.10 else 0 end
          as double) as expected_share
        from (select assignment_count, count(*) as shift_count from
          (select timesheet_id, count(*) as assignment_count from assignments group by all)
          group by all)""",
    # burnout
    "burnout_score": """select timesheet_id, cast(overtime as double) as overtime_hours,
        critical_cases, night_flag, consecutive_days_flag, emergency_cases, acute_score
        from scored""",
    "burnout_components": """select timesheet_id,
        cast(overtime * 2 as double) as score_overtime_hours,
        cast(critical_cases * 3 as double) as score_critical_cases,
        cast(night_flag * 5 as double) as score_night_flag,
        cast(consecutive_days_flag * 4 as double) as score_consecutive_days_flag,
        cast(emergency_cases * 3 as double) as score_emergency_cases from scored""",
    "burnout_risk_label": """select timesheet_id, acute_score,
        case when acute_score <= 30 then 'Low' when acute_score <= 55 then 'Medium'
          when acute_score <= 75 then 'High' else 'Critical' end as burnout_risk_label
        from scored""",
    "burnout_susceptibility": """select timesheet_id, role, home_department, experience_level,
        cast(susceptible as double) as susceptibility from scored""",
    "acute_load": "select timesheet_id, cast(load as double) as acute_load from scored",
    "chronic_prob": "select timesheet_id, cast(p as double) as chronic_prob from probable",
    "chronic_uplift": """select f.timesheet_id, acute_score, chronic_boost, t.burnout_score,
        burnout_risk_label from final f join timesheet t using (timesheet_id)""",
    # leave
    "worked_days": "select * from worked",
    "leave_window": "select leave_id, leave_start, duration_days, leave_end from asked",
    "leave_shift_conflicts": """select leave_id, staff_id, leave_start, leave_end from asked a
        where exists (select 1 from worked w where w.staff_id = a.staff_id
          and w.shift_date between a.leave_start and a.leave_end)""",
    "leave_resolve_conflicts": """select leave_id, staff_id, cast(k as bigint) as moved_days,
        leave_start, leave_end from moved""",
    "leave_days_count": "select leave_id, leave_start, leave_end, leave_days_count from leaves",
    "leave_residual_conflicts": """select leave_id, staff_id, leave_start, leave_end from leaves l
        where exists (select 1 from worked_in_window w where w.staff_id = l.staff_id
          and w.shift_date between l.leave_start and l.leave_end)""",
    # dimensions and facts
    "dim_date": """select cast(strftime(d, '%Y%m%d') as bigint) as date_key, d as full_date,
        dayname(d) as day_of_week, cast(isodow(d) - 1 as integer) as day_num,
        week(d) as week_number, cast(month(d) as integer) as month_num,
        monthname(d) as month_name, cast(quarter(d) as integer) as quarter,
        cast(year(d) as integer) as year,
        cast(case when isodow(d) >= 6 then 1 else 0 end as bigint) as is_weekend,
        cast(case when d in (select surge_day from surge_days) then 1 else 0 end as bigint)
          as is_surge_period
        from (select cast(unnest(generate_series(make_date(year(min(l_shipdate)), 1, 1),
          make_date(year(max(l_shipdate)), 12, 31), interval 1 day)) as date) as d
          from lineitem)""",
    "dim_department": """select d.*, coalesce(shift_count, 0) as shift_count from (values
        ('DEPT_01', 'ICU', 'Very High', cast(1 as bigint)), ('DEPT_02', 'ER', 'Very High', 1),
        ('DEPT_03', 'General Ward', 'Medium', 0), ('DEPT_04', 'Pediatrics', 'Medium', 0),
        ('DEPT_05', 'Oncology', 'High', 1), ('DEPT_06', 'Cardiology', 'High', 1),
        ('DEPT_07', 'Radiology', 'Low', 0), ('DEPT_08', 'Pathology', 'Low', 0))
        as d(dept_id, department_name, risk_category, is_critical_dept)
        left join (select department_override, count(*) as shift_count from shifts group by 1) s
        on s.department_override = d.department_name""",
    "dim_shift_type": """select t.*, coalesce(shift_count, 0) as shift_count from (values
        (cast(1 as bigint), 'Day', cast(7 as bigint), cast(1.0 as double),
          'Standard Daytime Shift (07:0019:00)'),
        (2, 'Night', 19, 1.5, 'Night / On-call Shift   (19:0007:00)'))
        as t(shift_type_id, shift_type_name, shift_start_hr, burnout_weight, description)
        left join (select shift_type, count(*) as shift_count from shifts group by 1) s
        on s.shift_type = t.shift_type_name""",
    "dim_staff": """select staff_id, staff_name, gender, role, experience_level, department,
        hire_date, employment_type, shift_preference, status, base_location, per_hour_rate,
        salary_band, night_shift_female_flag from staff_master""",
    "iso_year_week": """select timesheet_id, shift_date,
        strftime(shift_date, '%G-W%V') as year_week from shifts""",
    "fact_burnout": """select printf('BF_%08d', row_number() over (order by w.staff_id,
        w.year_week)) as burnout_fact_id, w.*, s.role, s.salary_band, s.gender, s.department
        from weekly w left join staff_master s on w.staff_id = s.staff_id""",
    "worst_risk": "select staff_id, year_week, worst_burnout_risk from weekly",
    "fact_overtime": """select printf('OT_%08d', row_number() over (order by timesheet_id))
        as overtime_fact_id, timesheet_id, staff_id, shift_date, shift_type, overtime_hours,
        shift_duration_hours, burnout_score, burnout_risk_label, surge_period_flag,
        consecutive_days_flag, back_to_back_12h_flag, night_to_day_flip_flag, female_night_flag
        from timesheet where overtime_hours > 0""",
    "fact_leave": """select printf('LF_%08d', row_number() over (order by leave_id))
        as leave_fact_id, *, cast(case when emergency_leave_flag or leave_days_count >= 10
          then 1 else 0 end as bigint) as burnout_leave_flag from leaves""",
    # quality
    "qa_table_summary": """
        select 'staff_master' as table_name, count(*) as row_count,
          cast(14 as bigint) as column_count, 'staff_id, staff_name, gender, role, '
          || 'experience_level, department, hire_date, shift_preference, status, base_location, '
          || 'employment_type, per_hour_rate, salary_band, night_shift_female_flag'
          as column_names from staff_master
        union all select 'staff_timesheet', count(*), 20, 'timesheet_id, staff_id, shift_date, '
          || 'shift_start, shift_end, shift_type, shift_duration_hours, overtime_hours, '
          || 'break_minutes, department_override, logged_hours_flag, burnout_score, '
          || 'burnout_risk_label, surge_period_flag, consecutive_days_flag, '
          || 'back_to_back_12h_flag, night_to_day_flip_flag, female_night_flag, '
          || 'overtime_multiplier, overtime_pay' from shifts
        union all select 'patient_assignment', count(*), 10, 'assignment_id, staff_id, '
          || 'patient_id, assignment_date, severity_level, department, case_type, '
          || 'assignment_duration_minutes, critical_flag, surge_emergency_flag' from assignments
        union all select 'leave_records', count(*), 8, 'leave_id, staff_id, leave_start, '
          || 'leave_end, leave_type, leave_days_count, approval_status, emergency_leave_flag'
          from requests""",
    "qa_home_shift_mismatch": """select count(*) as shift_count,
        count(*) filter (where department_override is distinct from home_department)
          as mismatches,
        round_even(count(*) filter (where department_override is distinct from home_department)
          * 100.0 / count(*), 2) as mismatch_pct from shifts""",
    "qa_shift_assignment_mismatch": """select count(*) as assignment_count,
        count(*) filter (where not ok) as mismatches,
        round_even(count(*) filter (where not ok) * 100.0 / count(*), 2) as mismatch_pct
        from (select exists (select 1 from shifts h where h.staff_id = a.staff_id
          and h.shift_date = a.assignment_date and h.department_override = a.department) as ok
          from raw_assignments a)""",
    "qa_argument_checks": """
        select 'no_active_staff' as check_name,
          cast(case when count(*) = 0 then 1 else 0 end as bigint) as violations
          from staff where status = 'Active'
        union all select 'no_leave_eligible_staff',
          cast(case when count(*) = 0 then 1 else 0 end as bigint)
          from staff where status is distinct from 'Inactive'
        union all select 'shift_of_unknown_staff', count(*) from all_shifts
          where staff_id not in (select staff_id from staff)
        union all select 'leave_of_unknown_staff', count(*) from raw_requests
          where staff_id not in (select staff_id from staff)
        union all select 'assignment_of_unknown_staff', count(*) from raw_assignments
          where staff_id not in (select staff_id from staff)
        union all select 'staff_of_unknown_role', count(*) from staff
          where role is null or role not in ('Nurse','Doctor','Admin','Surgeon','Radiologist',
            'Pharmacist','Physiotherapist','Technician')
        union all select 'assignment_count_unequal', count(*) from all_shifts h
          full join (select timesheet_id, count(*) as n from raw_assignments group by all) a
            using (timesheet_id)
          where coalesce(h.assignment_count, 0) <> coalesce(a.n, 0)""",
    "qa_inactive_with_shifts": """
        select status, cast(coalesce(sum(h.n), 0) as bigint) as shift_count,
          cast(coalesce(sum(l.n), 0) as bigint) as leave_count,
          cast(case when status <> 'Active' then coalesce(sum(h.n), 0) else 0 end
            + case when status = 'Inactive' then coalesce(sum(l.n), 0) else 0 end as bigint)
            as violations
        from staff s
          left join (select staff_id, count(*) as n from all_shifts group by all) h using (staff_id)
          left join (select staff_id, count(*) as n from raw_requests group by all) l using (staff_id)
        group by status""",
}


def oracle_sql() -> dict[str, str]:
    return {name: f"{BASE} {select}" for name, select in ORACLE.items()}
